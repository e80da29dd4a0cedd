"""Reading tables, keeping results in the shared folder, and joins of checked size."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.sources.shared import scratch_folder

# A side is broadcast up to so many rows, counted beforehand; beyond them the
# join is a shuffle. Such sides are a few numbers wide.
BROADCAST_ROWS = 200_000
# Whether a query's shuffle files are removed when it ends.
_FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed or sent along; then this adds nothing.
    """
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, purpose: str, place: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it again: its lineage is cut.

    What the write has shuffled goes when it ends, not when the driver next collects
    garbage. A ``place`` that is given is written over: nothing that is still to be
    read may be there, the frame itself least of all.
    """
    spark = df.sparkSession
    path = place or scratch_folder(spark, purpose)
    before = spark.conf.get(_FILES_GO, "false")
    spark.conf.set(_FILES_GO, "true")
    try:
        df.write.mode("overwrite" if place else "errorifexists").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_FILES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def text_hash(text: str | Column = "text") -> Column:
    """With the id, this tells rows apart whose ids are missing or repeated."""
    return F.xxhash64(text).alias("text_hash")


def about(df: DataFrame, rows: int, of: int, *names: str) -> DataFrame:
    """Some ``rows`` of the ``of`` rows of a frame, chosen by a hash of the columns.

    Tasks choose by themselves, so that no more than the sample reaches the driver.
    """
    share = F.lit(int(min(1.0, 1.2 * rows / max(1, of)) * (1 << 31)))
    return df.where(F.pmod(F.xxhash64(*names), F.lit(1 << 31)) < share).limit(rows)


COUNTED = "place bigint, n bigint"


def counted(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a task counted, by place, in batches of bounded size; zeros are left out."""
    places = np.flatnonzero(counts)
    for at in range(0, len(places), 1 << 16):
        some = places[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["place", "n"])


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """The tasks' counts (``COUNTED``) added up by place, of which there are ``size``."""
    found = parts.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, dtype=np.int64)
    out[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return out


def if_small(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a kept frame for broadcast if it has few rows; counting reads footers."""
    return F.broadcast(side) if side.count() <= rows else side


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equality on all names, in which nulls are equal."""
    out = F.lit(True)
    for name in names:
        out = out & left[name].eqNullSafe(right[name])
    return out


def only(docs: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` in (``left_semi``) or not in (``left_anti``) a kept frame.

    ``chosen`` holds doc_id and text_hash. All columns of ``docs`` stay,
    whatever they are called.
    """
    chosen = if_small(chosen.select("doc_id", F.col("text_hash").alias("_chosen")))
    match = docs["doc_id"].eqNullSafe(chosen["doc_id"]) & F.xxhash64(docs["text"]).eqNullSafe(
        chosen["_chosen"]
    )
    return docs.join(chosen, match, how)
