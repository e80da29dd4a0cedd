"""The eight tables: columns, types and place in the lake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_DATE = "data_carga"
LAYERS = ("bronze", "silver", "gold")

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}

_WHOLE = (T.IntegerType, T.LongType)
_FRACTIONS = (T.DoubleType, T.FloatType, T.DecimalType)
_RANGES = {T.IntegerType: 2.0**31, T.LongType: 2.0**63}


def _narrowed(name: str, have: T.DataType | None, want: T.DataType) -> Column:
    """The column in another type, with nothing cut off."""
    value = F.col(name)
    if isinstance(want, T.IntegerType) and isinstance(have, T.LongType):
        good = value.between(-(2**31), 2**31 - 1)
    elif isinstance(want, _WHOLE) and isinstance(have, _FRACTIONS):
        limit = _RANGES[type(want)]
        number = value.cast("double")
        good = (value == F.rint(number)) & (number >= -limit) & (number < limit)
    else:
        return value.cast(want)
    said = F.concat(F.lit(f"{name} cannot be a whole number: "), value.cast("string"))
    return F.when(value.isNull() | good, value).otherwise(F.raise_error(said).cast(have)).cast(want)


@dataclass(frozen=True)
class Table:
    """One table of a layer; every table is partitioned by the load date."""

    layer: str
    name: str
    folder: str
    ddl: str

    @property
    def columns(self) -> list[tuple[str, str]]:
        return [tuple(part.split()) for part in self.ddl.split(",")]

    @property
    def struct(self) -> T.StructType:
        fields = [T.StructField(name, _TYPES[kind]) for name, kind in self.columns]
        return T.StructType([*fields, T.StructField(LOAD_DATE, T.StringType())])

    def location(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.folder}"

    def conform(self, df: DataFrame) -> DataFrame:
        """Exactly the table's columns, in order, in the table's types.

        A column that already has its type is passed through bare, so filters
        on it still reach the files. A fraction, or a number out of range, under a
        whole-number column is an error.
        """
        have = {field.name: field.dataType for field in df.schema}
        return df.select(
            *[
                F.col(field.name)
                if have.get(field.name) == field.dataType
                else _narrowed(field.name, have.get(field.name), field.dataType).alias(field.name)
                for field in self.struct
            ]
        )


# --- Fixed values: table names, folders, columns and types ------------------
BRONZE_BASKET = Table(
    "bronze", "cesta_basica", "bronze/dieese/cesta_basica",
    "data_mes string, cidade string, valor double",
)
BRONZE_RENT = Table(
    "bronze", "aluguel_medio", "bronze/aluguel_medio",
    "id int, city string, area int, rooms int, bathroom int, parking_spaces int,"
    " floor int, animal int, furniture int, hoa int, rent_amount int,"
    " property_tax int, fire_insurance int, total int",
)
BRONZE_POP_UF = Table(
    "bronze", "populacao_estimada_uf", "bronze/ibge/populacao_estimada/brasil_uf",
    "unidade_federativa string, populacao int",
)
BRONZE_POP_MUN = Table(
    "bronze", "populacao_estimada_municipios", "bronze/ibge/populacao_estimada/municipios",
    "uf string, cod_uf int, cod_municipio int, municipio string, populacao int",
)
SILVER_RENT = Table(
    "silver", "aluguel_populacao", "silver/aluguel_populacao",
    "area int, rooms int, bathroom int, parking_spaces int, floor int, animal int,"
    " furniture int, rent_amount int, total int, city_codigo int, city string,"
    " aluguel_m2 double, populacao int, aluguel_per_capita double",
)
SILVER_BASKET = Table(
    "silver", "cesta_basica_full", "silver/cesta_basica_full",
    "city_code int, cidade_cesta string, uf string, valor_cesta double,"
    " cod_municipio bigint, populacao bigint, estado string",
)
GOLD_RENT = Table(
    "gold", "aluguel_populacao_gold", "gold/aluguel_populacao_gold",
    "city string, aluguel_m2_calculado double, total_cost double, aluguel_per_room double",
)
GOLD_BASKET = Table(
    "gold", "cesta_basica_gold", "gold/cesta_basica_gold",
    "city_code int, cidade_cesta string, estado string, valor_cesta_medio double,"
    " populacao bigint, valor_total_gasto double",
)

TABLES = (
    BRONZE_BASKET, BRONZE_RENT, BRONZE_POP_UF, BRONZE_POP_MUN,
    SILVER_RENT, SILVER_BASKET, GOLD_RENT, GOLD_BASKET,
)
