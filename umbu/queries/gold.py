"""Gold tables, and whole histories from bronze to gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu import schemas as S
from umbu.plans import gold, silver
from umbu.plans.runs import Lake
from umbu.queries.registry import query
from umbu.queries.silver import SILVER_BASKET_SQL, silver_rent_sql
from umbu.queries.views import (
    LISTINGS_SQL,
    listings,
    load_dates,
    mean_sql,
    population,
    prices,
    state_towns,
)
from umbu.sources.loads import read_loads, write_loads
from umbu.sources.shared import scratch_folder


def _gold_rent_sql(source: str, city: str) -> str:
    return f"""
SELECT {city} AS city,
       CASE WHEN area > 0 THEN CAST(rent_amount AS DOUBLE) / area END AS aluguel_m2_calculado,
       CAST(rent_amount AS DOUBLE) + total AS total_cost,
       CASE WHEN rooms > 0 THEN CAST(rent_amount AS DOUBLE) / rooms END AS aluguel_per_room,
       data_carga
FROM {source}"""


_GOLD_BASKET_SQL = f"""
WITH {SILVER_BASKET_SQL}, means AS (
  SELECT city_code, cidade_cesta, estado, data_carga,
         {mean_sql("valor_cesta")} AS valor_cesta_medio,
         CAST(coalesce(sum(populacao), 0) AS BIGINT) AS populacao
  FROM silver_basket
  WHERE city_code IS NOT NULL AND cidade_cesta IS NOT NULL AND estado IS NOT NULL
  GROUP BY city_code, cidade_cesta, estado, data_carga)
SELECT city_code, cidade_cesta, estado, valor_cesta_medio, populacao,
       round_even(valor_cesta_medio * populacao, 2) AS valor_total_gasto, data_carga
FROM means"""


@query(f"WITH {LISTINGS_SQL} {_gold_rent_sql('listings', 'city')}")
def gold_rent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_rent(listings(spark, sf_dir))


@query(_GOLD_BASKET_SQL)
def gold_basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices to silver to gold, in one plan."""
    return gold.gold_basket(
        silver.silver_basket(prices(spark, sf_dir), population(spark, sf_dir))
    )


@query(_GOLD_BASKET_SQL)
def backfill_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All loads of prices: bronze, silver and gold written and read as tables.

    Each layer is one job over all load dates, not one job per date. The calendar
    has many dates without a load, which are passed over.
    """
    root = scratch_folder(spark, "backfill")
    dates = load_dates(spark, sf_dir, "orders", "o_orderdate")
    write_loads(prices(spark, sf_dir), root, S.BRONZE_BASKET, dates)
    write_loads(population(spark, sf_dir), root, S.BRONZE_POP_MUN, dates)
    lake = Lake(spark, root, registered=False)
    lake.backfill(dates[0], dates[-1])
    return read_loads(spark, root, S.GOLD_BASKET, dates)


@query(f"WITH {silver_rent_sql(['id'])} {_gold_rent_sql('silver_rent', 'city')}")
def backfill_rents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the rents."""
    root = scratch_folder(spark, "backfill")
    dates = load_dates(spark, sf_dir, "lineitem", "l_shipdate")
    write_loads(listings(spark, sf_dir), root, S.BRONZE_RENT, dates)
    write_loads(state_towns(spark, sf_dir), root, S.BRONZE_POP_MUN, dates)
    lake = Lake(spark, root, registered=False)
    lake.backfill(dates[0], dates[-1])
    return read_loads(spark, root, S.GOLD_RENT, dates)


@query(f"""
WITH {silver_rent_sql(['id'])}, gold AS ({_gold_rent_sql('silver_rent', 'city')}),
lines AS (SELECT data_carga, count(*) AS rows FROM gold GROUP BY data_carga)
SELECT data_carga AS load, rows, CASE row_number() OVER (ORDER BY data_carga)
         WHEN 1 THEN 'first' WHEN 2 THEN 'gold only' ELSE 'second' END AS written
FROM lines""")
def catch_up_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake that has one load, lacks the gold of another and all of the rest.

    Catching up writes what is lacking and nothing else; once more writes nothing.
    Gold rows by load, with the run that wrote them.
    """
    root = scratch_folder(spark, "catch-up")
    dates = load_dates(spark, sf_dir, "lineitem", "l_shipdate")
    write_loads(listings(spark, sf_dir), root, S.BRONZE_RENT, dates)
    write_loads(state_towns(spark, sf_dir), root, S.BRONZE_POP_MUN, dates)
    lake = Lake(spark, root, registered=False)
    lake.silver_rent(dates[:2])
    lake.gold_rent(dates[:1])
    files = lambda: {
        r["path"] for r in spark.read.format("binaryFile").load(S.GOLD_RENT.location(root)).select("path").collect()
    }
    before = files()
    reports = lake.catch_up(dates[0], dates[-1])
    wrote = {r.table.partition(".")[0]: set(r.loads) for r in reports}
    if wrote != {"silver": {*dates[2:]}, "gold": {*dates[1:]}} or not before <= files():
        raise AssertionError(f"catching up wrote {wrote}")
    if again := lake.catch_up(dates[0], dates[-1]):
        raise AssertionError(f"nothing was due, but {again} was written")
    rows = lake.read(S.GOLD_RENT, dates).groupBy(F.col(S.LOAD_DATE).alias("load"))
    written = (
        F.when(F.col("load") == dates[0], "first")
        .when(F.col("load") == dates[min(1, len(dates) - 1)], "gold only")
        .otherwise("second")
    )
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("written", written)
