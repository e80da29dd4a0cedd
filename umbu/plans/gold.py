"""Silver tables to gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbu.functions.casts import lenient_long
from umbu.functions.numeric import ratio_guarded, round_half_even, stable_mean, sum_or_zero
from umbu.operators.rows import group_known
from umbu.plans.silver import numeric
from umbu.schemas import GOLD_BASKET, GOLD_RENT, LOAD_DATE

BASKET_KEYS = ("city_code", "cidade_cesta", "estado", LOAD_DATE)


def whole(df: DataFrame, *names: str) -> DataFrame:
    """Read text columns as whole numbers where they are; typed columns stay."""
    text = [name for name, kind in df.dtypes if kind == "string" and name in names]
    return df.withColumns({name: lenient_long(F.col(name)) for name in text}) if text else df


def gold_rent(silver: DataFrame) -> DataFrame:
    """Rent per area, total cost and rent per room, listing by listing."""
    df = whole(numeric(silver, "area", "rent_amount", "total"), "rooms")
    rent = F.col("rent_amount")
    return GOLD_RENT.conform(
        df.withColumns(
            {
                "aluguel_m2_calculado": ratio_guarded(rent, F.col("area")),
                "total_cost": rent.cast("double") + F.col("total").cast("double"),
                "aluguel_per_room": ratio_guarded(rent, F.col("rooms")),
            }
        )
    )


def gold_basket(silver: DataFrame) -> DataFrame:
    """Mean basket price and spending per city and load.

    The population is added once per price row, so it counts every month.
    """
    df = numeric(whole(silver, "city_code", "populacao"), "valor_cesta")
    grouped = group_known(
        df,
        BASKET_KEYS,
        round_half_even(stable_mean(F.col("valor_cesta")), 2).alias("valor_cesta_medio"),
        sum_or_zero(F.col("populacao")).alias("populacao"),
    )
    spent = F.col("valor_cesta_medio") * F.col("populacao")
    return GOLD_BASKET.conform(grouped.withColumn("valor_total_gasto", round_half_even(spent, 2)))
