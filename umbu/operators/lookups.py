"""Dimensions stated in code. At most 27 rows each, so always broadcast."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.fixed_values import CITY_UFS, STATES, UF_CODES
from umbu.functions.numeric import spread_index
from umbu.functions.text import fold


def _inline(spark: SparkSession, rows: Iterable[Sequence], names: str) -> DataFrame:
    """Rows as SQL ``VALUES``: Spark knows their size and folds what is done to them."""

    def literal(value) -> str:
        if value is None:
            return "NULL"
        return str(value) if isinstance(value, int) else f"'{value}'"

    values = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def state_dimension(spark: SparkSession) -> DataFrame:
    return _inline(spark, STATES, "city_codigo, city_nome")


def uf_dimension(spark: SparkSession) -> DataFrame:
    """UF → state code → state name; seven UFs have no code and are not here."""
    names = dict(STATES)
    rows = [(uf, code, names[code]) for uf, code in UF_CODES]
    return _inline(spark, rows, "uf, city_code, estado")


def city_dimension(spark: SparkSession) -> DataFrame:
    """City as named in the price sheet → UF, state code and name (maybe null)."""
    codes, names = dict(UF_CODES), dict(STATES)
    rows = [(city, uf, codes.get(uf), names.get(codes.get(uf))) for city, uf in CITY_UFS]
    return _inline(spark, rows, "cidade_cesta, uf, city_code, estado")


def folded_states(spark: SparkSession) -> DataFrame:
    """State code and folded state name: 20 names are folded, not every row."""
    return state_dimension(spark).select("city_codigo", fold(F.col("city_nome")).alias("city"))


def with_state_name(df: DataFrame) -> DataFrame:
    """Add ``city_nome`` by ``city_codigo``; unknown codes stay, with null."""
    return df.join(F.broadcast(state_dimension(df.sparkSession)), "city_codigo", "left")


def with_uf_code(df: DataFrame, uf: str = "uf") -> DataFrame:
    """Add ``city_code`` and ``estado`` by UF; unknown UFs stay, with nulls."""
    lookup = uf_dimension(df.sparkSession).withColumnRenamed("uf", uf)
    return df.join(F.broadcast(lookup), uf, "left")


def fill_uf(df: DataFrame) -> DataFrame:
    """Where ``uf`` is null take the UF of the raw ``cidade_cesta``, if known."""
    known = city_dimension(df.sparkSession).select("cidade_cesta", F.col("uf").alias("known_uf"))
    return (
        df.join(F.broadcast(known), "cidade_cesta", "left")
        .withColumn("uf", F.coalesce("uf", "known_uf"))
        .drop("known_uf")
    )


def assigned_state(keys: Sequence[Column], seed: int) -> Column:
    """A state code for a row, spread evenly, decided by its key alone."""
    codes = F.array(*[F.lit(code) for code, _ in STATES])
    return F.get(codes, spread_index(keys, seed, len(STATES)))
