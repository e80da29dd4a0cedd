"""Joins on folded names, and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.fixed_values import CITY_UFS
from umbu.functions.text import city_key, fold
from umbu.operators.joins import join_dimension
from umbu.operators.lookups import (
    assigned_state,
    fill_uf,
    state_dimension,
    with_state_name,
    with_uf_code,
)
from umbu.plans.silver import SEED
from umbu.queries.registry import query
from umbu.queries.views import (
    CITY_UF_SQL,
    NATION_CITY_SQL,
    STATES_SQL,
    UF_SQL,
    customer_city,
    fold_sql,
    nation_city,
    spread_sql,
    table,
    values,
)


@query(f"""
SELECT s.city_codigo, s.city_nome, count(c_custkey) AS customers
FROM {STATES_SQL} LEFT JOIN customer ON s.i = {spread_sql(["c_custkey"], SEED, 20)}
GROUP BY s.city_codigo, s.city_nome""")
def dim_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every state with the customers assigned to it, counted before the join."""
    counted = (
        table(spark, sf_dir, "customer")
        .groupBy(assigned_state([F.col("c_custkey")], SEED).alias("city_codigo"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    return (
        state_dimension(spark)
        .join(counted, "city_codigo", "left")
        .select("city_codigo", "city_nome", F.coalesce("customers", F.lit(0)).alias("customers"))
    )


@query(f"""
SELECT c_custkey, CAST(100 + 10 * (c_custkey % 50) AS INT) AS city_codigo, s.city_nome
FROM customer LEFT JOIN {STATES_SQL} ON s.city_codigo = 100 + 10 * (c_custkey % 50)""")
def join_dim_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State names by code; codes that name no state stay."""
    code = (100 + 10 * (F.col("c_custkey") % 50)).cast("int")
    return with_state_name(
        table(spark, sf_dir, "customer").select("c_custkey", code.alias("city_codigo"))
    )


# Supplier towns: the names as written officially, some of them unknown.
_TOWNS_SQL = f"""{NATION_CITY_SQL},
towns AS (
  SELECT n_nationkey AS town_code,
         CASE WHEN n_nationkey % 4 = 0 THEN 'Vila ' || n_name ELSE upper(municipio) END AS town
  FROM nation_city
),
homes AS (
  SELECT c_custkey, replace({fold_sql("cidade")}, '_', ' ') AS city
  FROM customer JOIN nation_city ON c_nationkey = n_nationkey
)"""


def _towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    town = F.when(
        F.col("n_nationkey") % 4 == 0, F.concat(F.lit("Vila "), "n_name")
    ).otherwise(F.upper("municipio"))
    return nation_city(spark, sf_dir).select(
        F.col("n_nationkey").alias("town_code"), fold(town).alias("city")
    )


def _homes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_city(spark, sf_dir).select(
        "c_custkey", city_key(F.col("cidade")).alias("city")
    )


@query(f"""
WITH {_TOWNS_SQL}
SELECT c_custkey, city, town_code FROM homes JOIN towns ON city = {fold_sql("town")}""")
def join_norm_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with every town of their city's name."""
    return join_dimension(_homes(spark, sf_dir), _towns(spark, sf_dir), "city")


@query(f"""
WITH {_TOWNS_SQL}
SELECT c_custkey, city, town_code FROM homes LEFT JOIN towns ON city = {fold_sql("town")}""")
def join_norm_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the customers whose city names no town."""
    return join_dimension(_homes(spark, sf_dir), _towns(spark, sf_dir), "city", "left")


_UFS = [(i, uf) for i, (_, uf) in enumerate(CITY_UFS)]
_UFS_SQL = values(_UFS, "f", "i, uf")


@query(f"""
SELECT c_custkey, f.uf, u.city_code, u.estado
FROM customer JOIN {_UFS_SQL} ON c_custkey % 27 = f.i LEFT JOIN {UF_SQL} ON u.uf = f.uf""")
def lookup_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State code and name by UF; seven of the UFs have none."""
    ufs = F.array(*[F.lit(uf) for _, uf in _UFS])
    return with_uf_code(
        table(spark, sf_dir, "customer").select(
            "c_custkey", F.get(ufs, (F.col("c_custkey") % 27).cast("int")).alias("uf")
        )
    )


_RAW_SQL = """CASE WHEN c_custkey % 6 = 0 THEN 'cidade nova' ELSE cidade END"""
_UF_HOLE_SQL = "CASE WHEN c_custkey % 3 = 0 THEN uf END"


@query(f"""
WITH {NATION_CITY_SQL}, homes AS (
  SELECT c_custkey, {_RAW_SQL} AS cidade_cesta, {_UF_HOLE_SQL} AS uf
  FROM customer JOIN nation_city ON c_nationkey = n_nationkey)
SELECT c_custkey, homes.cidade_cesta, coalesce(homes.uf, k.uf) AS uf
FROM homes LEFT JOIN {CITY_UF_SQL} ON k.cidade_cesta = homes.cidade_cesta""")
def lookup_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The UF at hand, or else the one its raw city name stands for, or none."""
    return fill_uf(
        customer_city(spark, sf_dir).select(
            "c_custkey",
            F.expr(_RAW_SQL).alias("cidade_cesta"),
            F.expr(_UF_HOLE_SQL).alias("uf"),
        )
    )
