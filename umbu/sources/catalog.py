"""Databases, external tables and partitions of the lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from umbu.functions.dates import load_date
from umbu.schemas import LAYERS, LOAD_DATE, Table
from umbu.sources.loads import load_path


def _text(value: str) -> str:
    """A string literal of SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_name(table: Table, prefix: str = "") -> str:
    return f"`{prefix}{table.layer}`.`{table.name}`"


def create_databases(spark: SparkSession, root: str, prefix: str = "") -> None:
    """One database per layer; ``prefix`` keeps trial catalogs apart."""
    for layer in LAYERS:
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}`"
            f" LOCATION {_text(f"{root.rstrip('/')}/{layer}")}"
        )


def create_table(spark: SparkSession, root: str, table: Table, prefix: str = "") -> None:
    """External Parquet table over the table's folder, partitioned by load date."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table_name(table, prefix)}"
        f" ({table.ddl}, {LOAD_DATE} string) USING parquet"
        f" PARTITIONED BY ({LOAD_DATE}) LOCATION {_text(table.location(root))}"
    )


def register_loads(
    spark: SparkSession, root: str, table: Table, dates: Sequence[str], prefix: str = ""
) -> None:
    """Add loads to the catalog in one request; loads it has are left alone."""
    partitions = " ".join(
        f"PARTITION ({LOAD_DATE}='{load_date(d)}') LOCATION {_text(load_path(root, table, d))}"
        for d in dates
    )
    spark.sql(f"ALTER TABLE {table_name(table, prefix)} ADD IF NOT EXISTS {partitions}")


def listed_loads(spark: SparkSession, table: Table, prefix: str = "") -> set[str]:
    """The load dates that the catalog has of a table."""
    rows = spark.sql(f"SHOW PARTITIONS {table_name(table, prefix)}").collect()
    return {row[0].partition("=")[2] for row in rows}


def switch_loads(spark: SparkSession, table: Table, folders: dict[str, str], prefix: str = "") -> None:
    """Point the catalog's loads at other folders; a load at a time, each at once.

    Who reads a load by the table's name finds all of its old files or all of its new
    ones. Loads the catalog lacks are added first, in one request.
    """
    if not folders:
        return
    known, name = listed_loads(spark, table, prefix), table_name(table, prefix)
    part = lambda day: f"PARTITION ({LOAD_DATE}='{load_date(day)}')"
    if new := [day for day in folders if day not in known]:
        added = " ".join(f"{part(day)} LOCATION {_text(folders[day])}" for day in new)
        spark.sql(f"ALTER TABLE {name} ADD {added}")
    for day in sorted({*folders} & known):
        spark.sql(f"ALTER TABLE {name} {part(day)} SET LOCATION {_text(folders[day])}")


def databases(spark: SparkSession, prefix: str = "") -> list[tuple[str, str, int]]:
    """Layer, place and number of tables of each database that the session has of a lake."""
    found = {db.name: db.locationUri for db in spark.catalog.listDatabases(f"{prefix}*")}
    return [
        (layer, found[prefix + layer], len(spark.catalog.listTables(prefix + layer)))
        for layer in LAYERS
        if prefix + layer in found
    ]


def repair_table(spark: SparkSession, table: Table, prefix: str = "") -> None:
    """Add every load found in the table's folder to the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {table_name(table, prefix)}")
