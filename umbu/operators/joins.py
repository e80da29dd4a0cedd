"""Joins of a large frame with a smaller one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, rows: int | None = None, size: int | None = None) -> bool:
    """Measure a frame: row count and bytes of its cells, summed on the cluster."""
    rows = BROADCAST_ROWS if rows is None else rows
    size = BROADCAST_BYTES if size is None else size
    cells = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
    width = sum(cells, F.lit(0)).cast("bigint")
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("size")).first()
    return found["rows"] <= rows and (found["size"] or 0) <= size


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    fits: bool | None = None,
) -> DataFrame:
    """Equi-join that broadcasts the dimension only if it was measured small.

    ``fits`` gives the outcome of ``fits_broadcast`` where the caller has it,
    for this frame or one that bounds it. Past the bound the join is left to
    Spark: a shuffle on the keys, where adaptive execution splits a key that
    holds most of the rows. Every match is kept, so equal names in the dimension
    multiply rows.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    if fits_broadcast(dimension) if fits is None else fits:
        dimension = F.broadcast(dimension)
    return facts.join(dimension, [on] if isinstance(on, str) else list(on), how)
