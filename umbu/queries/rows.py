"""Columns, filters, grouping, reshaping and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.functions.numeric import round_half_even, stable_mean, sum_or_zero
from umbu.operators.columns import clean_names, drop
from umbu.operators.columns import rename as rename_columns
from umbu.operators.rows import drop_missing, group_known, unpivot
from umbu.queries.registry import query
from umbu.queries.views import LISTINGS_SQL, listings, mean_sql, table


@query("""
SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand,
       p_size AS size, p_retailprice AS retail_price FROM part""")
def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers in mixed case, with blanks and hyphens, to column names."""
    headers = ["Part Key", " Part-Name ", "BRAND", "size", "Retail price"]
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"
    )
    return clean_names(part.toDF(*headers))


@query("""
SELECT p_partkey AS part_key, p_name AS "part-name", p_retailprice AS "retail-price"
FROM part""")
def normalize_columns_hyphen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where hyphens belong to the name."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    return clean_names(part.toDF("Part Key", " Part-Name", "RETAIL-PRICE "), hyphen=False)


@query("SELECT p_partkey AS codigo, p_name AS nome, p_brand, p_retailprice AS valor FROM part")
def rename_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename and drop by name; names the frame lacks do no harm."""
    names = {"p_partkey": "codigo", "p_name": "nome", "p_retailprice": "valor", "absent": "x"}
    return drop(
        rename_columns(table(spark, sf_dir, "part"), names), ["p_type", "p_size", "missing"]
    )


@query(f"""
WITH {LISTINGS_SQL}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, area, rooms, total
FROM listings WHERE area IS NOT NULL AND rooms IS NOT NULL""")
def dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_missing(listings(spark, sf_dir), ["area", "rooms"]).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "area", "rooms", "total"
    )


@query(f"""
WITH {LISTINGS_SQL}
SELECT area, rooms, furniture, count(*) AS listings, CAST(sum(total) AS BIGINT) AS total
FROM listings WHERE area IS NOT NULL AND rooms IS NOT NULL
GROUP BY area, rooms, furniture""")
def group_dropnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_known(
        listings(spark, sf_dir),
        ["area", "rooms", "furniture"],
        F.count(F.lit(1)).alias("listings"),
        F.sum("total").alias("total"),
    )


@query(f"""
SELECT l_returnflag, l_linestatus,
       {mean_sql("l_extendedprice")} AS mean_price,
       {mean_sql("CASE WHEN l_returnflag <> 'N' THEN l_quantity END")} AS mean_known,
       {mean_sql("l_tax", 6)} AS mean_tax
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_mean_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounded means; where no value is known the mean is null."""
    known = F.when(F.col("l_returnflag") != "N", F.col("l_quantity"))
    return group_known(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        round_half_even(stable_mean(F.col("l_extendedprice")), 2).alias("mean_price"),
        round_half_even(stable_mean(known), 2).alias("mean_known"),
        round_half_even(stable_mean(F.col("l_tax")), 6).alias("mean_tax"),
    )


@query(f"""
WITH {LISTINGS_SQL}
SELECT parking_spaces, animal,
       CAST(coalesce(sum(total), 0) AS BIGINT) AS total,
       CAST(coalesce(sum(CASE WHEN parking_spaces <> 2 THEN area END), 0) AS BIGINT) AS area
FROM listings GROUP BY parking_spaces, animal""")
def agg_sum_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums; where no value is known the sum is zero."""
    known = F.when(F.col("parking_spaces") != 2, F.col("area"))
    return group_known(
        listings(spark, sf_dir),
        ["parking_spaces", "animal"],
        sum_or_zero(F.col("total")).alias("total"),
        sum_or_zero(known).alias("area"),
    )


_CELLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_IDS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_CELL_SQL = {c: f"nullif({c}, 0)" for c in _CELLS}


@query(
    " UNION ALL ".join(
        f"SELECT {', '.join(_IDS)}, '{c}' AS measure, {_CELL_SQL[c]} AS valor FROM lineitem"
        for c in _CELLS
    )
)
def unpivot_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line and measure; empty cells stay."""
    wide = table(spark, sf_dir, "lineitem").select(
        *_IDS, *[F.nullif(F.col(c), F.lit(0)).alias(c) for c in _CELLS]
    )
    return unpivot(wide, _IDS, "measure", "valor")
