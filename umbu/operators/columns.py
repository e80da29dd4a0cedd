"""Column names, projection, the load-date column."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbu.functions.dates import load_date
from umbu.schemas import LOAD_DATE


def clean_name(name: str, hyphen: bool = True) -> str:
    """Header to column name; ``hyphen=False`` leaves hyphens as they are."""
    return re.sub("[ -]" if hyphen else " ", "_", name.strip().lower())


def clean_names(df: DataFrame, hyphen: bool = True) -> DataFrame:
    return df.toDF(*[clean_name(name, hyphen) for name in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by name; names the frame lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def drop(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop by name; names the frame lacks are ignored."""
    return df.drop(*names)


def all_but(df: DataFrame, *names: str) -> list[str]:
    return [name for name in df.columns if name not in names]


def with_load_dates(df: DataFrame, dates: str | Sequence[str]) -> DataFrame:
    """Stamp rows with a load date; with several dates, one copy for each."""
    dates = [load_date(d) for d in ([dates] if isinstance(dates, str) else dates)]
    if len(dates) == 1:
        return df.withColumn(LOAD_DATE, F.lit(dates[0]))
    return df.withColumn(LOAD_DATE, F.explode(F.array(*map(F.lit, dates))))
