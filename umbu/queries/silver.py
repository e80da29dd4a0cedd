"""Silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu import schemas as S
from umbu.plans import silver
from umbu.plans.runs import Lake
from umbu.plans.silver import SEED
from umbu.queries.registry import query
from umbu.queries.views import (
    CITY_UF_SQL,
    LISTINGS_SQL,
    POPULATION_SQL,
    PRICES_SQL,
    STATE_TOWNS_SQL,
    STATES_SQL,
    UF_SQL,
    fold_sql,
    listings,
    load_dates,
    population,
    prices,
    spread_sql,
    state_towns,
)
from umbu.sources.loads import write_loads
from umbu.sources.shared import scratch_folder

ROW_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")

SILVER_BASKET_SQL = f"""{PRICES_SQL}, {POPULATION_SQL},
joined AS (
  SELECT prices.cidade AS cidade_cesta, coalesce(p.uf, k.uf) AS uf, valor AS valor_cesta,
         CAST(p.cod_municipio AS BIGINT) AS cod_municipio,
         CAST(p.populacao AS BIGINT) AS populacao, prices.data_carga
  FROM prices
    LEFT JOIN population AS p ON p.data_carga = prices.data_carga
      AND {fold_sql("p.municipio")} = replace({fold_sql("prices.cidade")}, '_', ' ')
    LEFT JOIN {CITY_UF_SQL} ON k.cidade_cesta = prices.cidade
),
silver_basket AS (
  SELECT u.city_code, cidade_cesta, joined.uf, valor_cesta, cod_municipio, populacao,
         u.estado, data_carga
  FROM joined LEFT JOIN {UF_SQL} ON u.uf = joined.uf
)"""


@query(f"WITH {SILVER_BASKET_SQL} SELECT * FROM silver_basket")
def silver_basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_basket(prices(spark, sf_dir), population(spark, sf_dir))


def silver_rent_sql(keys: list[str]) -> str:
    return f"""{LISTINGS_SQL}, {STATE_TOWNS_SQL},
silver_rent AS (
  SELECT area, rooms, bathroom, parking_spaces, floor, animal, furniture, rent_amount, total,
         s.city_codigo, {fold_sql("s.city_nome")} AS city,
         round_even(CAST(total AS DOUBLE) / area, 2) AS aluguel_m2, populacao,
         round_even(CAST(total AS DOUBLE) / populacao, 6) AS aluguel_per_capita,
         listings.data_carga
  FROM listings
    JOIN {STATES_SQL} ON s.i = {spread_sql(keys, SEED, 20)}
    JOIN towns ON towns.data_carga = listings.data_carga
      AND {fold_sql("municipio")} = {fold_sql("s.city_nome")}
  WHERE area IS NOT NULL AND total IS NOT NULL
)"""


@query(f"WITH {silver_rent_sql(list(ROW_KEYS))} SELECT * FROM silver_rent")
def silver_rent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_rent(listings(spark, sf_dir), state_towns(spark, sf_dir), ROW_KEYS)


@query(f"WITH {silver_rent_sql(['id'])} SELECT * FROM silver_rent")
def empty_result_keeps_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rents, run again when no listing can be used: the old loads stand.

    The first run fills all loads; then the listings lose their area, so that the
    second run has no rows and replaces nothing.
    """
    root = scratch_folder(spark, "empty")
    dates = load_dates(spark, sf_dir, "lineitem", "l_shipdate")
    rents = listings(spark, sf_dir)
    write_loads(rents, root, S.BRONZE_RENT, dates)
    write_loads(state_towns(spark, sf_dir), root, S.BRONZE_POP_MUN, dates)
    lake = Lake(spark, root, registered=False)
    lake.silver_rent(dates)
    write_loads(rents.withColumn("area", F.lit(None).cast("int")), root, S.BRONZE_RENT, dates)
    report = lake.silver_rent(dates)
    if report.rows or report.loads:
        raise AssertionError(f"an empty result wrote {report.loads}")
    return lake.read(S.SILVER_RENT, dates)
