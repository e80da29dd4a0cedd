"""Loads: the files of a table for one load date."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from umbu.functions.dates import load_date
from umbu.schemas import LOAD_DATE, Table
from umbu.sources.footers import footers, read_as, read_type

# Below a table's folder; scans pass over names that begin so.
VERSIONS = "_versions"


@dataclass(frozen=True)
class LoadReport:
    """What a write did: rows, loads replaced, column types and their place."""

    table: str
    path: str
    rows: int
    loads: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]


def _listed(dates: Sequence[str]) -> Column:
    """The row's load date; a row of no load or of an unlisted one fails its task."""
    day = F.col(LOAD_DATE)
    said = F.concat(F.lit("a row of load "), F.coalesce(day, F.lit("null")), F.lit(" is not to be written"))
    return F.when(day.isin(dates), day).otherwise(F.raise_error(said).cast("string"))


def load_path(root: str, table: Table, day: str) -> str:
    return f"{table.location(root)}/{LOAD_DATE}={load_date(day)}"


def path_load_date(path: Column) -> Column:
    """The load date named in a path, null if it names none."""
    found = F.regexp_extract(path, f"{LOAD_DATE}=([^/]+)", 1)
    return F.nullif(found, F.lit(""))


def read_loads(
    spark: SparkSession, root: str, table: Table, dates: str | Sequence[str]
) -> DataFrame:
    """All Parquet files of one or more loads.

    Only the folders of these loads are listed, whatever else the table holds.
    Any load without Parquet files raises ``FileNotFoundError``. A file that lacks a
    column, or holds it in a type the table's cannot be made of, raises ``ValueError``
    with its name. Numbers are read as wide as the files hold them and those wider than
    the table's narrowed with a check, so that loads of different widths can be read
    together.
    """
    dates = [dates] if isinstance(dates, str) else list(dates)
    paths = [load_path(root, table, day) for day in dates]
    try:
        return _read(spark, root, table, paths, {load_date(day) for day in dates})
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise _absent(table, dates) from problem
        raise


def _absent(table: Table, dates: Sequence[str]) -> FileNotFoundError:
    return FileNotFoundError(f"no Parquet file for {table.layer}.{table.name}, load {', '.join(dates)}")


def _read(spark: SparkSession, root: str, table: Table, paths: list[str], wanted: set[str]) -> DataFrame:
    """Files compared with the table by their footers, and read shape by shape."""
    reader = lambda: spark.read.option("basePath", table.location(root)).option("pathGlobFilter", "*.parquet")
    found = footers(reader().format("binaryFile").load(paths), table)
    held = found.groupBy(LOAD_DATE, "shape", "problem").agg(F.min("path").alias("path")).collect()
    if bad := sorted((r["path"], r["problem"]) for r in held if r["problem"]):
        said = "; ".join(f"{path}: {problem}" for path, problem in bad[:5])
        raise ValueError(f"{table.layer}.{table.name}: {said}")
    if absent := sorted(wanted - {r[LOAD_DATE] for r in held}):
        raise _absent(table, absent)
    shapes = read_as([r["shape"] for r in held])
    if not shapes:
        return spark.createDataFrame([], table.struct)
    out = None
    for shape, theirs in shapes.items():
        # Files of one shape, as is usual, are read by their folders.
        of = paths if len(shapes) == 1 else [r[0] for r in found.where(F.col("shape").isin(theirs)).select("path").collect()]
        part = reader().schema(read_type(shape)).parquet(*of)
        nulls = {name: F.lit(None) for name, _ in table.columns if name not in part.columns}
        part = table.conform(part.withColumns(nulls) if nulls else part)
        out = part if out is None else out.unionByName(part)
    return out


def held_files(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """load and number of Parquet files, of each load in the table's folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    nothing = spark.sql("SELECT '' AS load, 0L AS files WHERE false")
    try:
        found = files.load(table.location(root))
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return nothing
        raise
    if LOAD_DATE not in found.columns:
        return nothing
    day = F.col(LOAD_DATE).cast("string").alias("load")
    return found.groupBy(day).agg(F.count(F.lit(1)).alias("files"))


def held_loads(spark: SparkSession, root: str, table: Table) -> set[str]:
    """The load dates of which the table's folder holds Parquet files."""
    return {row["load"] for row in held_files(spark, root, table).collect()}


def days_frame(spark: SparkSession, dates: Sequence[str]) -> DataFrame:
    """A calendar as a frame of one column, load."""
    days = F.array(*[F.lit(load_date(day)) for day in dates]).cast("array<string>")
    return spark.range(1).select(F.explode(days).alias("load"))


def load_outcomes(spark: SparkSession, root: str, table: Table, dates: Sequence[str]) -> DataFrame:
    """load, found, files of each date asked for: what ``read_loads`` would meet."""
    held = days_frame(spark, dates).join(held_files(spark, root, table), "load", "left")
    files = F.coalesce("files", F.lit(0).cast("bigint"))
    return held.select("load", (files > 0).alias("found"), files.alias("files"))


def read_table(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """Every load of a table; a filter on the load date prunes folders.

    Files are compared with the table as in ``read_loads``.
    """
    return _read(spark, root, table, [table.location(root)], set())


def write_loads(
    df: DataFrame,
    root: str,
    table: Table,
    dates: str | Sequence[str],
    keep_empty: bool = False,
    clustered: bool = False,
) -> LoadReport:
    """Replace the listed loads that occur in the frame; other loads stay as they are.

    A row whose load date is null or not listed fails the write before anything is
    replaced. The write itself counts rows and notes their load dates, so nothing is
    computed twice to find out whether a load is empty. A load without rows replaces
    nothing, unless ``keep_empty``: then it becomes an empty load, written apart.

    Rows of several loads are first brought together by load, in even parts, to
    spare small files. One load needs no such shuffle, nor do rows that are
    ``clustered``: read from the files of their loads and not shuffled since.
    """
    dates = sorted({load_date(d) for d in ([dates] if isinstance(dates, str) else dates)})
    out, rows, loads = _written(df, table, dates, clustered, table.location(root))
    if keep_empty:
        nothing = table.conform(df.limit(0)).drop(LOAD_DATE)
        for day in sorted({*dates} - {*loads}):
            nothing.write.mode("overwrite").parquet(load_path(root, table, day))
        loads = dates
    return LoadReport(
        f"{table.layer}.{table.name}", table.location(root), rows, tuple(loads), tuple(out.dtypes)
    )


def _written(df: DataFrame, table: Table, dates: list[str], clustered: bool, place: str):
    """Write the loads below a folder: the frame written, its rows and its loads."""
    out = table.conform(df).withColumn(LOAD_DATE, _listed(dates))
    if len(dates) > 1 and not clustered:
        out = out.hint("rebalance", LOAD_DATE)
    seen = Observation()
    (
        out.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(LOAD_DATE).alias("days"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD_DATE)
        .parquet(place)
    )
    return out, seen.get["rows"], sorted(seen.get["days"] or [])


def write_version(
    df: DataFrame,
    root: str,
    table: Table,
    dates: str | Sequence[str],
    keep_empty: bool = False,
    clustered: bool = False,
) -> tuple[LoadReport, dict[str, str]]:
    """Write loads to folders of their own, where no reader looks: a report, and the
    folder of each load, for the catalog to be pointed at.

    The folders are below the table's, under a name that scans of the table pass over.
    Whatever fails here leaves every earlier load as it was. Loads without rows are
    treated as in ``write_loads``.
    """
    dates = sorted({load_date(d) for d in ([dates] if isinstance(dates, str) else dates)})
    place = f"{table.location(root)}/{VERSIONS}/{uuid.uuid4().hex}"
    out, rows, loads = _written(df, table, dates, clustered, place)
    folders = {day: f"{place}/{LOAD_DATE}={day}" for day in loads}
    if keep_empty:
        nothing = table.conform(df.limit(0)).drop(LOAD_DATE)
        for day in sorted({*dates} - {*loads}):
            folders[day] = f"{place}/{LOAD_DATE}={day}"
            nothing.write.mode("overwrite").parquet(folders[day])
    report = LoadReport(
        f"{table.layer}.{table.name}", place, rows, tuple(sorted(folders)), tuple(out.dtypes)
    )
    return report, folders
