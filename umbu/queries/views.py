"""Listings, prices, towns and sheets seen in the supplied tables.

Each view exists twice, as a frame and as the SQL text the checks start from.
The supplied tables hold no nulls, misses or equal names, so the views make some
by rule; no view leaves rows out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.fixed_values import CITY_UFS, STATES, UF_CODES
from umbu.functions.dates import iso_date
from umbu.operators.columns import with_load_dates
from umbu.schemas import LOAD_DATE


# Columns of the supplied tables; naming them saves a look into each file.
_COLUMNS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def values(rows, alias: str, names: str) -> str:
    """``FROM`` item that holds the rows, for both engines."""

    def literal(value) -> str:
        if value is None:
            return "NULL"
        return str(value) if isinstance(value, int) else f"'{value}'"

    body = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return f"(VALUES {body}) AS {alias}({names})"


def year_start(moment: Column) -> Column:
    return F.concat(F.year(moment).cast("string"), F.lit("-01-01"))


# --- Towns: nations under the names of Brazilian cities ---------------------
# 25 nations share 20 city names, so five names occur twice.
CITY_ROWS = [
    (i, name, name.replace("_", " ").title(), uf) for i, (name, uf) in enumerate(CITY_UFS[:20])
]
STATE_ROWS = [(i, name) for i, (_, name) in enumerate(STATES)]

NATION_CITY_SQL = f"""
nation_city AS (
  SELECT n_nationkey, n_name, n_regionkey, c.cidade, c.municipio, c.uf
  FROM nation JOIN {values(CITY_ROWS, "c", "i, cidade, municipio, uf")}
    ON n_nationkey % 20 = c.i
)"""


def nation_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation with the city whose name it borrows."""
    names = spark.sql(f"SELECT * FROM {values(CITY_ROWS, 'c', 'i, cidade, municipio, uf')}")
    nation = table(spark, sf_dir, "nation").withColumn("i", F.col("n_nationkey") % 20)
    return nation.join(F.broadcast(names), "i").drop("i")


def customer_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer with the city of its nation.

    Spark knows the size of the nation file and broadcasts it if it is small.
    """
    cities = nation_city(spark, sf_dir).withColumnRenamed("n_nationkey", "c_nationkey")
    return table(spark, sf_dir, "customer").join(cities, "c_nationkey")


# --- Prices: orders as basket prices ----------------------------------------
PRICES_SQL = f"""{NATION_CITY_SQL},
prices AS (
  SELECT o_orderkey, n_nationkey,
         strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS data_mes,
         cidade,
         CASE WHEN n_nationkey % 11 <> 5 THEN o_totalprice END AS valor,
         strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS data_carga
  FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation_city ON c_nationkey = n_nationkey
)"""


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price per order, by month and city of the customer; loads are years.

    Orders and customers both grow, so that join is left to Spark; only the two
    columns needed of the customer take part in it.
    """
    homes = customer_city(spark, sf_dir).select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"), "cidade"
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    return orders.join(homes, "o_custkey").select(
        "o_orderkey",
        "n_nationkey",
        iso_date(F.trunc("o_orderdate", "month")).alias("data_mes"),
        "cidade",
        F.when(F.col("n_nationkey") % 11 != 5, F.col("o_totalprice")).alias("valor"),
        year_start(F.col("o_orderdate")).alias(LOAD_DATE),
    )


def load_dates(spark: SparkSession, sf_dir: str, name: str, moment: str) -> list[str]:
    """The loads in a table, one per year: a list as long as the history."""
    years = table(spark, sf_dir, name).select(year_start(F.col(moment)).alias("d")).distinct()
    return sorted(row["d"] for row in years.collect())


# --- Population: customers of a nation as inhabitants of a town -------------
# Every fourth nation takes a name no price knows, every seventh has no UF.
def _population_sql(source: str, moment: str) -> str:
    return f"""
people AS (
  SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey
),
population AS (
  SELECT CASE WHEN n_nationkey % 7 <> 3 THEN uf END AS uf,
         n_regionkey AS cod_uf, n_nationkey AS cod_municipio,
         CASE WHEN n_nationkey % 4 = 0 THEN 'Vila ' || n_name ELSE municipio END AS municipio,
         CAST(CASE WHEN n_nationkey % 11 <> 6 THEN n END AS INT) AS populacao,
         d.data_carga
  FROM nation_city LEFT JOIN people ON n_nationkey = c_nationkey,
    (SELECT DISTINCT strftime(date_trunc('year', {moment}), '%Y-%m-%d') AS data_carga
     FROM {source}) AS d
)"""


POPULATION_SQL = _population_sql("orders", "o_orderdate")


def _headcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per nation, counted before the shuffle."""
    customer = table(spark, sf_dir, "customer")
    return customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("n")
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Towns with their population, the same in every load."""
    key = F.col("n_nationkey")
    towns = nation_city(spark, sf_dir).join(_headcount(spark, sf_dir), "n_nationkey", "left")
    stamped = towns.select(
        F.when(key % 7 != 3, F.col("uf")).alias("uf"),
        F.col("n_regionkey").alias("cod_uf"),
        key.alias("cod_municipio"),
        F.when(key % 4 == 0, F.concat(F.lit("Vila "), "n_name"))
        .otherwise(F.col("municipio"))
        .alias("municipio"),
        F.when(key % 11 != 6, F.col("n")).cast("int").alias("populacao"),
    )
    return with_load_dates(stamped, load_dates(spark, sf_dir, "orders", "o_orderdate"))


# Towns named after states, for the rents: 25 nations share 18 state names.
STATE_TOWNS_SQL = f"""
people AS (
  SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey
),
towns AS (
  SELECT upper(s.estado) AS municipio, CAST(n AS INT) AS populacao, d.data_carga
  FROM nation JOIN {values(STATE_ROWS, "s", "i, estado")} ON n_nationkey % 18 = s.i
    LEFT JOIN people ON n_nationkey = c_nationkey,
    (SELECT DISTINCT strftime(date_trunc('year', l_shipdate), '%Y-%m-%d') AS data_carga
     FROM lineitem) AS d
)"""


def state_towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.sql(f"SELECT * FROM {values(STATE_ROWS, 's', 'i, estado')}")
    nation = table(spark, sf_dir, "nation").withColumn("i", F.col("n_nationkey") % 18)
    towns = nation.join(F.broadcast(names), "i").join(
        _headcount(spark, sf_dir), "n_nationkey", "left"
    )
    stamped = towns.select(
        F.lit("XX").alias("uf"),
        F.col("n_regionkey").alias("cod_uf"),
        F.col("n_nationkey").alias("cod_municipio"),
        F.upper("estado").alias("municipio"),
        F.col("n").cast("int").alias("populacao"),
    )
    return with_load_dates(stamped, load_dates(spark, sf_dir, "lineitem", "l_shipdate"))


# --- Listings: order lines as rent listings ---------------------------------
LISTINGS_SQL = """
listings AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CAST(l_orderkey % 2147483647 AS INT) AS id,
         'Cidade ' || l_returnflag AS city,
         nullif(CAST(floor(l_quantity) AS INT), 13) AS area,
         nullif(l_linenumber, 7) AS rooms,
         l_linenumber % 3 + 1 AS bathroom,
         CAST(l_partkey % 4 AS INT) AS parking_spaces,
         CAST(l_suppkey % 12 AS INT) AS floor,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS animal,
         CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS furniture,
         CAST(floor(l_extendedprice / 100) AS INT) AS hoa,
         CAST(floor(l_extendedprice) AS INT) AS rent_amount,
         CAST(l_partkey % 1000 AS INT) AS property_tax,
         CAST(l_suppkey % 100 AS INT) AS fire_insurance,
         CAST(floor(l_extendedprice * (1 + l_tax)) AS INT) AS total,
         strftime(date_trunc('year', l_shipdate), '%Y-%m-%d') AS data_carga
  FROM lineitem
)"""


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing per order line; loads are years of shipping."""
    col, flag = F.col, lambda test: F.when(test, F.lit(1)).otherwise(F.lit(0))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        (col("l_orderkey") % 2147483647).cast("int").alias("id"),
        F.concat(F.lit("Cidade "), "l_returnflag").alias("city"),
        F.nullif(F.floor("l_quantity").cast("int"), F.lit(13)).alias("area"),
        F.nullif(col("l_linenumber"), F.lit(7)).alias("rooms"),
        (col("l_linenumber") % 3 + 1).alias("bathroom"),
        (col("l_partkey") % 4).cast("int").alias("parking_spaces"),
        (col("l_suppkey") % 12).cast("int").alias("floor"),
        flag(col("l_returnflag") == "R").alias("animal"),
        flag(col("l_linestatus") == "O").alias("furniture"),
        F.floor(col("l_extendedprice") / 100).cast("int").alias("hoa"),
        F.floor("l_extendedprice").cast("int").alias("rent_amount"),
        (col("l_partkey") % 1000).cast("int").alias("property_tax"),
        (col("l_suppkey") % 100).cast("int").alias("fire_insurance"),
        F.floor(col("l_extendedprice") * (1 + col("l_tax"))).cast("int").alias("total"),
        year_start(col("l_shipdate")).alias(LOAD_DATE),
    )


# --- SQL for what several checks share --------------------------------------
def fold_sql(text: str) -> str:
    """Folded text; ``chr`` spells out the white space that is stripped."""
    spaces = " || ".join(f"chr({code})" for code in (32, 9, 10, 13, 11, 12, 28, 29, 30, 31))
    ascii_part = f"regexp_replace(strip_accents({text}), '[^\\x00-\\x7F]', '', 'g')"
    return f"trim(lower({ascii_part}), {spaces})"


def mean_sql(value: str, digits: int = 2) -> str:
    """Rounded mean from a sum of whole cents; the tables' values have two decimals."""
    total = f"CAST(sum(CAST(round({value} * 100) AS BIGINT)) AS DOUBLE) / 100"
    return f"round_even({total} / nullif(count({value}), 0), {digits})"


def spread_sql(keys: list[str], seed: int, buckets: int) -> str:
    terms = " + ".join(f"(coalesce({key}, 0) % 1000003) * {7919 * (i + 1)}" for i, key in enumerate(keys))
    return f"(({terms} + {seed}) % 999983) % {buckets}"


UF_SQL = values(
    [(uf, code, dict(STATES)[code]) for uf, code in UF_CODES], "u", "uf, city_code, estado"
)
CITY_UF_SQL = values(CITY_UFS, "k", "cidade_cesta, uf")
STATES_SQL = values(
    [(i, code, name) for i, (code, name) in enumerate(STATES)], "s", "i, city_codigo, city_nome"
)
