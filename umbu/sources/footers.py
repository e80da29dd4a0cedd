"""What the files of a load hold, read from their footers on the cluster.

Spark reads a column that a file lacks as nulls, and takes the types of one file for
those of all. So the footers of all files are looked at first, in tasks, and compared
with the table: a file without a column, or with one in a type that the table's
cannot be made of, is named. What is left has a *shape*: the type each of the table's
columns is to be read with. Files of one shape can be read together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umbu.schemas import LOAD_DATE, Table

_ROWS = f"path string, {LOAD_DATE} string, shape string, problem string"
# The types of files that a table's types can be made of; void is a column of nulls.
_READABLE = {
    "int": ("int", "bigint", "double", "decimal", "void"),
    "bigint": ("int", "bigint", "double", "decimal", "void"),
    "double": ("int", "bigint", "double", "decimal", "void"),
    "string": ("string", "void"),
}
_ABSENT = "void"


def _kind(held: pa.DataType) -> str:
    """The type a column is to be read with: no wider than the file's, so that what
    fits the table's needs no check row by row."""
    if pa.types.is_dictionary(held):
        held = held.value_type
    if pa.types.is_uint64(held):
        return "decimal(20,0)"
    if pa.types.is_integer(held):
        return "int" if held.bit_width < 32 or pa.types.is_int32(held) else "bigint"
    if pa.types.is_float32(held) or pa.types.is_float64(held):
        return "double"
    if pa.types.is_decimal(held) and held.precision <= 38:
        return f"decimal({held.precision},{held.scale})"
    if pa.types.is_string(held) or pa.types.is_large_string(held):
        return "string"
    return "void" if pa.types.is_null(held) else str(held)


def compared(held: pa.Schema, columns: list[tuple[str, str]]) -> tuple[str | None, str | None]:
    """The shape of a file, or else what is wrong with it."""
    shape, wrong = [], []
    for name, want in columns:
        places = held.get_all_field_indices(name)
        kind = _kind(held.field(places[0]).type) if len(places) == 1 else None
        if kind is None:
            wrong.append(f"{'no' if not places else 'more than one'} column {name}")
        elif kind.split("(")[0] not in _READABLE[want]:
            wrong.append(f"column {name} holds {kind}, not {want}")
        else:
            shape.append(f"{name} {kind}")
    return (None, "; ".join(wrong)) if wrong else (", ".join(shape), None)


def _schema(path: str) -> pa.Schema | None:
    """A file's schema from its footer, or None where only Spark opens its store."""
    scheme, colon, rest = path.partition(":")
    uri = f"{'s3' if scheme in ('s3a', 's3n') else scheme}{colon}{quote(rest, safe='/=@:,+')}"
    try:
        store, place = fs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, OSError):
        return None
    with store.open_input_file(place) as file:
        return pq.read_schema(file)


def _row(path: str, day: str | None, schema: pa.Schema | None, columns) -> tuple:
    return (path, day, *((None, None) if schema is None else compared(schema, columns)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cells = list(zip(*rows)) or [()] * 4
    names = ["path", LOAD_DATE, "shape", "problem"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in cells], names=names)


def footers(files: DataFrame, table: Table) -> DataFrame:
    """path, load, shape or problem of files listed by a ``binaryFile`` scan.

    Only footers are read, unless the files are in a store that just Spark can open:
    then their contents are passed on.
    """
    columns = table.columns

    def by_path(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([_row(p, d, _schema(p), columns) for p, d in zip(*[c.to_pylist() for c in batch.columns])])

    def by_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch(
                [
                    _row(p, d, pq.read_schema(pa.BufferReader(content.as_buffer())), columns)
                    for p, d, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
                ]
            )

    day = F.col(LOAD_DATE).cast("string") if LOAD_DATE in files.columns else F.lit(None).cast("string")
    listed = files.select("path", day.alias(LOAD_DATE))
    first = listed.limit(1).collect()
    if first and _opens(first[0]["path"]):
        return listed.mapInArrow(by_path, _ROWS)
    return files.select("path", day.alias(LOAD_DATE), "content").mapInArrow(by_content, _ROWS)


def _opens(path: str) -> bool:
    """Whether the store of a file can be opened without Spark."""
    try:
        return _schema(path) is not None
    except OSError:
        return False


def read_as(shapes: list[str]) -> dict[str, list[str]]:
    """The shapes to read files with, each with those of the files it is for.

    A column that some files hold as int and some as bigint is a bigint in all, so
    that files which differ in nothing else are read together.
    """
    wide = {cell for shape in shapes for cell in shape.split(", ") if cell.endswith(" bigint")}
    out: dict[str, list[str]] = {}
    for shape in sorted({*shapes}):
        cells = [re.sub(" int$", " bigint", cell) for cell in shape.split(", ")]
        cells = [new if new in wide else old for old, new in zip(shape.split(", "), cells)]
        out.setdefault(", ".join(cells), []).append(shape)
    return out


def read_type(shape: str) -> T.StructType:
    """The schema to read files of a shape with: without columns of nulls."""
    kept = [part for part in shape.split(", ") if not part.endswith(f" {_ABSENT}")]
    fields = T.StructType.fromDDL(", ".join(kept)) if kept else T.StructType()
    return T.StructType([*fields, T.StructField(LOAD_DATE, T.StringType())])
