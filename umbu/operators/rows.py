"""Dropping rows, grouping them, turning columns into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where any of the columns is null or NaN."""
    return df.dropna(subset=list(columns))


def group_known(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Group by keys, leaving out rows with a missing key.

    The aggregates combine before the shuffle, so a key that holds most of the
    rows costs one row per map task.
    """
    return drop_missing(df, keys).groupBy(*keys).agg(*aggregates)


def unpivot(
    df: DataFrame, ids: Sequence[str], name: str, value: str, kind: str = "double"
) -> DataFrame:
    """One row per id and remaining column; empty cells stay as null rows."""
    cells = [c for c in df.columns if c not in ids]
    typed = df.select(*ids, *[F.col(f"`{c}`").cast(kind).alias(c) for c in cells])
    return typed.unpivot(list(ids), [F.col(f"`{c}`") for c in cells], name, value)
