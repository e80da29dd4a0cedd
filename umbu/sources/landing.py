"""Scans of landed raw files: CSV with a header, and sheets with a preamble."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Quotes inside a quoted cell are doubled, as spreadsheets export them.
QUOTING = {"escape": '"'}
# Every file's header must be the expected one, and every line must have its
# cells; lines are read whole for that, whichever columns are asked for.
STRICT = {"enforceSchema": False, "mode": "FAILFAST", "columnPruning": False}


def scan_csv(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All ``.csv`` files of a folder as text columns; casts come later.

    Types are not inferred, which would read everything twice. With ``columns``
    given no file is looked at beforehand. A file with other headers, or with them
    in another order, fails the job, and so does a line with too many or too few
    cells. Cells hold line breaks only with ``multi_line``, which reads each file
    in one piece.
    """
    options = {"header": True, "pathGlobFilter": "*.csv", "multiLine": multi_line, **QUOTING, **STRICT}
    reader = spark.read.options(**options)
    if not columns:
        columns = reader.csv(folder).columns
    return reader.schema(", ".join(f"`{name}` string" for name in columns)).csv(folder)


def sheet_header(spark: SparkSession, path: str, preamble: int) -> list[str]:
    """Column headers of a sheet: the line after the preamble."""
    line = spark.read.text(path).take(preamble + 1)[preamble]["value"]
    return next(csv.reader([line]))


def _below_top(preamble: int, header: Sequence[str] | None):
    """Lines of a task without the first ones of each file that begins in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for batch in batches:
            keep = [True] * batch.num_rows
            tops = pc.indices_nonzero(pc.equal(batch.column(2), 0)).to_pylist()
            for i in tops:
                file = batch.column(1)[i].as_py()
                number = seen.get(file, 0)
                if number > preamble:
                    continue
                seen[file] = number + 1
                keep[i] = False
                if number == preamble and header is not None:
                    found = next(csv.reader([batch.column(0)[i].as_py()]), [])
                    if found != list(header):
                        raise ValueError(f"{file}: the header is {found}, not {list(header)}")
            lines = batch.select([0])
            yield lines.filter(pa.array(keep)) if tops else lines

    return run


def scan_sheet(
    spark: SparkSession,
    path: str,
    preamble: int,
    names: Sequence[str],
    header: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of exported sheets as text, without preamble and header.

    Each file starts with ``preamble`` lines and a header line, which are left out
    by their place in the file; with ``header`` given, a file that has another one
    fails the job. Columns are named by position; a line with more or fewer cells
    fails the job. Large files are read in pieces: a task knows which of its pieces
    begin a file, and counts lines only there. Everything is read once.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    fields = ", ".join(f"`{name}` string" for name in names)
    row = F.from_csv("value", F.lit(fields), {**QUOTING, "mode": "FAILFAST"})
    return (
        lines.mapInArrow(_below_top(preamble, header), "value string")
        .where(F.trim("value") != "")
        .select(row.alias("row"))
        .select("row.*")
    )


def scan_sheet_columns(
    spark: SparkSession, path: str, preamble: int, picked: Mapping[str, str]
) -> DataFrame:
    """As ``scan_sheet``, but picks columns by their header and renames them."""
    header = sheet_header(spark, path, preamble)
    absent = [title for title in picked if title not in header]
    if absent:
        raise ValueError(f"the sheet has no column {', '.join(absent)}")
    names = [picked.get(title, f"column {i}") for i, title in enumerate(header)]
    return scan_sheet(spark, path, preamble, names, header).select(*picked.values())
