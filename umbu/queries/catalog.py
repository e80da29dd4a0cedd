"""Tables of a catalog over files written to the shared folder."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.plans.runs import Lake
from umbu.queries.registry import query
from umbu.queries.views import PRICES_SQL, load_dates, prices
from umbu.schemas import BRONZE_BASKET, LOAD_DATE, TABLES
from umbu.sources import catalog
from umbu.sources.loads import write_loads
from umbu.sources.shared import scratch_folder


def _new_lake(spark: SparkSession) -> Lake:
    """A lake with tables, in databases no other run uses."""
    lake = Lake(spark, scratch_folder(spark, "lake"), f"trial_{uuid.uuid4().hex[:12]}_")
    lake.create_catalog()
    return lake


def _by_load(rows: DataFrame) -> DataFrame:
    return rows.groupBy(LOAD_DATE).agg(
        F.count(F.lit(1)).alias("rows"), F.count("valor").alias("known")
    )


_BY_LOAD_SQL = f"""
WITH {PRICES_SQL}
SELECT data_carga, count(*) AS rows, count(valor) AS known FROM prices GROUP BY data_carga"""


@query(f"""
WITH {PRICES_SQL}
SELECT data_mes, cidade, valor, data_carga FROM prices""")
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight tables created, one of them filled and queried by name."""
    lake = _new_lake(spark)
    for item in TABLES:
        found = spark.table(catalog.table_name(item, lake.prefix)).schema
        if found.fieldNames() != item.struct.fieldNames():
            raise AssertionError(f"{item.name}: {found.simpleString()}")
    dates = load_dates(spark, sf_dir, "orders", "o_orderdate")
    lake.save(prices(spark, sf_dir), BRONZE_BASKET, dates)
    return lake.table(BRONZE_BASKET)


@query(f"""
WITH {PRICES_SQL}, layers(layer, place, tables) AS (
  VALUES ('bronze', 'bronze', 4), ('silver', 'silver', 2), ('gold', 'gold', 2))
SELECT layer, place, tables,
       CASE layer WHEN 'bronze' THEN (SELECT count(DISTINCT data_carga) FROM prices) ELSE 0 END AS loads,
       CASE layer WHEN 'bronze' THEN (SELECT count(*) FROM prices) ELSE 0 END AS rows
FROM layers""")
def catalog_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The databases that the session has, their places below the lake's root, their
    tables, and the loads and rows of these tables by name."""
    lake = _new_lake(spark)
    dates = load_dates(spark, sf_dir, "orders", "o_orderdate")
    lake.save(prices(spark, sf_dir), BRONZE_BASKET, dates)
    found = catalog.databases(spark, lake.prefix)
    below = {layer: place.partition(lake.root.partition(":")[2] or lake.root)[2].strip("/") for layer, place, _ in found}
    listed = ", ".join(f"('{layer}', '{below[layer]}', {tables})" for layer, _, tables in found)
    layers = spark.sql(f"SELECT * FROM VALUES {listed} AS t(layer, place, tables)")
    rows = None
    for item in TABLES:
        part = lake.table(item).select(F.lit(item.layer).alias("layer"), LOAD_DATE)
        rows = part if rows is None else rows.union(part)
    held = rows.groupBy("layer").agg(
        F.count_distinct(LOAD_DATE).alias("loads"), F.count(F.lit(1)).alias("rows")
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return layers.join(held, "layer", "left").select("layer", "place", "tables", zero("loads"), zero("rows"))


@query(f"""
WITH {PRICES_SQL}
SELECT data_mes, cidade, data_carga,
       CASE WHEN data_carga = (SELECT max(data_carga) FROM prices) THEN -valor ELSE valor END
         AS valor
FROM prices""")
def switch_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All loads written to folders of their own, the last once more with other values,
    and once in a way that fails; read through the catalog, which was switched."""
    lake = replace(_new_lake(spark), switched=True)
    dates, rows = load_dates(spark, sf_dir, "orders", "o_orderdate"), prices(spark, sf_dir)
    lake.save(rows, BRONZE_BASKET, dates)
    last = rows.where(F.col(LOAD_DATE) == dates[-1])
    lake.save(last.withColumn("valor", -F.col("valor")), BRONZE_BASKET, dates[-1])
    try:  # rows of other loads fail the write after some of its files are there
        lake.save(rows, BRONZE_BASKET, dates[0])
    except Exception as problem:
        if "is not to be written" not in str(problem):
            raise
    else:
        raise AssertionError("a row of another load was written")
    return lake.read(BRONZE_BASKET, dates)


@query(_BY_LOAD_SQL)
def register_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads added to the catalog by name, all in one request, and once more."""
    lake = _new_lake(spark)
    dates = load_dates(spark, sf_dir, "orders", "o_orderdate")
    write_loads(prices(spark, sf_dir), lake.root, BRONZE_BASKET, dates)
    for _ in range(2):
        catalog.register_loads(spark, lake.root, BRONZE_BASKET, dates, lake.prefix)
    return _by_load(lake.table(BRONZE_BASKET))


@query(_BY_LOAD_SQL)
def repair_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads found by searching the folder of the table."""
    lake = _new_lake(spark)
    dates = load_dates(spark, sf_dir, "orders", "o_orderdate")
    write_loads(prices(spark, sf_dir), lake.root, BRONZE_BASKET, dates)
    catalog.repair_table(spark, BRONZE_BASKET, lake.prefix)
    return _by_load(lake.table(BRONZE_BASKET))
