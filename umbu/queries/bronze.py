"""Bronze tables from raw frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.functions.numeric import round_half_even, stable_mean
from umbu.plans import bronze
from umbu.queries.registry import query
from umbu.queries.views import (
    LISTINGS_SQL,
    NATION_CITY_SQL,
    customer_city,
    listings,
    mean_sql,
    table,
)
from umbu.schemas import BRONZE_RENT

LOAD = "2025-05-01"

# Raw headers of the listings, in the order of the bronze columns.
RENT_HEADERS = [
    "ID", "City", "Area", "Rooms", "Bathroom", "Parking Spaces", "Floor", "Animal",
    "Furniture", "HOA", "Rent Amount", "Property-Tax", " Fire Insurance", "Total ",
]
RENT_NAMES = [name for name, _ in BRONZE_RENT.columns]


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings as they land: text cells under raw headers."""
    rows = listings(spark, sf_dir)
    return rows.select(*[F.col(c).cast("string") for c in RENT_NAMES]).toDF(*RENT_HEADERS)


@query(f"""
WITH {LISTINGS_SQL}
SELECT {", ".join(RENT_NAMES)}, '{LOAD}' AS data_carga FROM listings""")
def bronze_rent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_rent(raw_listings(spark, sf_dir), LOAD)


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price sheet: a row per day, a column per nation, headers as written.

    The headers are the nation names, read once; the mean of each cell is
    computed per day and nation first, and only then spread over the columns.
    """
    nations = [row["n_name"] for row in table(spark, sf_dir, "nation").toLocalIterator()]
    homes = customer_city(spark, sf_dir).select(
        F.col("c_custkey").alias("o_custkey"), F.col("n_name")
    )
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    cells = (
        orders.join(homes, "o_custkey")
        .groupBy("o_orderdate", "n_name")
        .agg(round_half_even(stable_mean(F.col("o_totalprice")), 2).alias("valor"))
    )
    wide = cells.groupBy(F.col("o_orderdate").alias("Data")).pivot("n_name", nations)
    headers = {name: f" {name.replace('_', ' ').title()}" for name in nations}
    return wide.agg(F.first("valor")).withColumnsRenamed(headers)


WIDE_PRICES_SQL = f"""
WITH {NATION_CITY_SQL}, cells AS (
  SELECT o_orderdate, n_name, {mean_sql("o_totalprice")} AS valor
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY o_orderdate, n_name)
SELECT strftime(d.o_orderdate, '%Y-%m-%d') AS data_mes, lower(n.n_name) AS cidade, c.valor,
       '{LOAD}' AS data_carga
FROM (SELECT DISTINCT o_orderdate FROM cells) AS d CROSS JOIN nation AS n
  LEFT JOIN cells AS c ON c.o_orderdate = d.o_orderdate AND c.n_name = n.n_name"""


@query(WIDE_PRICES_SQL)
def bronze_basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_basket(raw_prices(spark, sf_dir), LOAD)


def marked(number: Column) -> Column:
    """A count as a sheet shows it: with a separator, or a dash for none."""
    text = F.format_string("%d.%03d", F.floor(number / 1000), number % 1000)
    return F.when(number > 0, text).otherwise(F.lit("-"))


POPULATION_UF_SQL = f"""
SELECT c_mktsegment || '-' || n_name AS unidade_federativa,
       CAST(nullif(sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END), 0) AS INT) AS populacao,
       '{LOAD}' AS data_carga
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_mktsegment, n_name"""


def uf_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in credit per segment and nation, as text with separators."""
    in_credit = F.count_if(F.col("c_acctbal") > 0)
    return (
        customer_city(spark, sf_dir)
        .groupBy(F.concat_ws("-", "c_mktsegment", "n_name").alias("name"))
        .agg(in_credit.alias("n"))
        .select("name", marked(F.col("n")).alias("people"))
    )


@query(POPULATION_UF_SQL)
def bronze_pop_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_population_uf(uf_sheet(spark, sf_dir), LOAD)


def municipality_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a municipality; all cells are text."""
    people = F.floor(F.abs("c_acctbal"))
    return table(spark, sf_dir, "customer").select(
        F.substring("c_mktsegment", 1, 2).alias("uf"),
        F.format_string("%d.", "c_nationkey").alias("cod_uf"),
        F.format_string("(%d)", F.col("c_custkey") % 2147483647).alias("cod_municipio"),
        F.concat(F.col("c_name"), F.lit(', "São" José')).alias("municipio"),
        marked(people).alias("populacao"),
    )


MUNICIPALITIES_SQL = f"""
SELECT substr(c_mktsegment, 1, 2) AS uf, c_nationkey AS cod_uf,
       CAST(c_custkey % 2147483647 AS INT) AS cod_municipio,
       c_name || ', "São" José' AS municipio,
       CAST(nullif(floor(abs(c_acctbal)), 0) AS INT) AS populacao, '{LOAD}' AS data_carga
FROM customer"""


@query(MUNICIPALITIES_SQL)
def bronze_pop_mun(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_population_mun(municipality_sheet(spark, sf_dir), LOAD)
