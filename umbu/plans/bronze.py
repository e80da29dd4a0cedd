"""Raw frames to bronze tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbu.functions.casts import digits_to_long, strict_int
from umbu.functions.dates import iso_date
from umbu.operators.columns import clean_names, rename, with_load_dates
from umbu.operators.rows import unpivot
from umbu.schemas import BRONZE_BASKET, BRONZE_POP_MUN, BRONZE_POP_UF, BRONZE_RENT


def bronze_rent(raw: DataFrame, dates: str | Sequence[str]) -> DataFrame:
    """Listings as text → whole numbers; a cell that is none fails the load."""
    named = clean_names(raw)
    cells = [
        F.col(name).cast("string").alias(name)
        if kind == "string"
        else strict_int(F.col(name).cast("string"), kind, nullable=name != "id").alias(name)
        for name, kind in BRONZE_RENT.columns
    ]
    return BRONZE_RENT.conform(with_load_dates(named.select(*cells), dates))


def bronze_basket(
    wide: DataFrame, dates: str | Sequence[str], pattern: str | Sequence[str | None] | None = None
) -> DataFrame:
    """Price sheet with one column per city → one row per month and city.

    ``pattern`` is the form of the sheet's dates, where it is not the ISO one, or the
    forms, where they are mixed.
    """
    named = rename(clean_names(wide, hyphen=False), {"data": "data_mes"})
    dated = named.withColumn("data_mes", iso_date(F.col("data_mes"), pattern))
    long = unpivot(dated, ["data_mes"], "cidade", "valor")
    return BRONZE_BASKET.conform(with_load_dates(long, dates))


def bronze_population_uf(sheet: DataFrame, dates: str | Sequence[str]) -> DataFrame:
    """Population by UF; columns by position, numbers from text with marks."""
    named = sheet.toDF("unidade_federativa", "populacao").withColumn(
        "populacao", digits_to_long(F.col("populacao"))
    )
    return BRONZE_POP_UF.conform(with_load_dates(named, dates))


def bronze_population_mun(sheet: DataFrame, dates: str | Sequence[str]) -> DataFrame:
    """Population by municipality; codes and numbers from text with marks."""
    digits = {c: digits_to_long(F.col(c)) for c in ("cod_uf", "cod_municipio", "populacao")}
    return BRONZE_POP_MUN.conform(with_load_dates(sheet.withColumns(digits), dates))
