"""Bronze tables to silver tables.

Loads never mix: the load date is part of every join key, so many loads can go
through one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbu.functions.casts import lenient_double
from umbu.functions.numeric import ratio_ieee, round_half_even
from umbu.functions.text import city_key, fold
from umbu.operators.joins import join_dimension
from umbu.operators.lookups import assigned_state, city_dimension, folded_states, with_uf_code
from umbu.operators.rows import drop_missing
from umbu.schemas import LOAD_DATE, SILVER_BASKET, SILVER_RENT

SEED = 20


def numeric(df: DataFrame, *names: str) -> DataFrame:
    """Read text columns as numbers where they are; typed columns stay."""
    text = [name for name, kind in df.dtypes if kind == "string" and name in names]
    return df.withColumns({name: lenient_double(F.col(name)) for name in text}) if text else df


def silver_rent(
    listings: DataFrame,
    population: DataFrame,
    keys: Sequence[str] = ("id",),
    seed: int = SEED,
    towns_fit: bool | None = None,
) -> DataFrame:
    """Listings, each given a state, with the population of the town so named.

    The town replaces the listing's own city. Of the states only those that are
    also the name of a municipality survive, once for each such municipality.
    States and municipalities are matched first: that side stays small and the
    listings meet it once, by an integer code, with no text to fold per listing.
    ``keys`` are whole-number columns; a null one counts as 0. ``towns_fit`` tells
    whether the population was measured fit to broadcast.
    """
    towns = population.select(LOAD_DATE, fold(F.col("municipio")).alias("city"), "populacao")
    towns = towns.join(F.broadcast(folded_states(population.sparkSession)), "city")
    sized = drop_missing(numeric(listings, "area", "rent_amount", "total"), ["area", "total"])
    coded = sized.drop("city").withColumn(
        "city_codigo", assigned_state([F.col(k) for k in keys], seed)
    )
    placed = join_dimension(coded, towns, [LOAD_DATE, "city_codigo"], fits=towns_fit)
    total = F.col("total")
    return SILVER_RENT.conform(
        placed.withColumns(
            {
                "aluguel_m2": round_half_even(ratio_ieee(total, F.col("area")), 2),
                "aluguel_per_capita": round_half_even(ratio_ieee(total, F.col("populacao")), 6),
            }
        )
    )


def silver_basket(
    prices: DataFrame, population: DataFrame, towns_fit: bool | None = None
) -> DataFrame:
    """Prices with UF, state and population of their city; every price is kept.

    Where no municipality gives a UF, the city's raw name does. State code and
    name are looked up on the two small sides, so a price row takes two
    broadcast lookups instead of four. The one by raw name comes first and also
    brings the folded name along: text is folded only for names not listed.
    ``towns_fit`` tells whether the population was measured fit to broadcast.
    """
    spark = prices.sparkSession
    towns = with_uf_code(
        population.select(
            LOAD_DATE,
            fold(F.col("municipio")).alias("city"),
            F.col("uf").alias("town_uf"),
            "cod_municipio",
            "populacao",
        ),
        "town_uf",
    ).withColumnsRenamed({"city_code": "town_code", "estado": "town_state"})
    raw_name = F.col("cidade_cesta")
    named = city_dimension(spark).select(
        "cidade_cesta",
        city_key(raw_name).alias("named_city"),
        F.col("uf").alias("named_uf"),
        F.col("city_code").alias("named_code"),
        F.col("estado").alias("named_state"),
    )
    known = prices.withColumnsRenamed({"cidade": "cidade_cesta", "valor": "valor_cesta"}).join(
        F.broadcast(named), "cidade_cesta", "left"
    )
    keyed = known.withColumn("city", F.coalesce("named_city", city_key(raw_name)))
    joined = join_dimension(keyed, towns, [LOAD_DATE, "city"], "left", towns_fit)
    in_town = F.col("town_uf").isNotNull()
    return SILVER_BASKET.conform(
        joined.withColumns(
            {
                "uf": F.coalesce("town_uf", "named_uf"),
                "city_code": F.when(in_town, F.col("town_code")).otherwise(F.col("named_code")),
                "estado": F.when(in_town, F.col("town_state")).otherwise(F.col("named_state")),
            }
        )
    )
