"""Rounding, ratios, means and spreading keys over buckets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int) -> Column:
    """Round the way NumPy does: scale, round half to even, scale back.

    ``F.round`` (half up) and ``F.bround`` (exact decimals) differ from it.
    """
    scale = float(10**digits)
    return F.rint(value.cast("double") * scale) / scale


def ratio_ieee(num: Column, den: Column) -> Column:
    """Quotient where x/0 is signed infinity, 0/0 is NaN and null stays null."""
    num, den = num.cast("double"), den.cast("double")
    at_zero = (
        F.when(num > 0, F.lit(float("inf")))
        .when(num < 0, F.lit(float("-inf")))
        .when(num == 0, F.lit(float("nan")))
    )
    return F.when(den == 0, at_zero).otherwise(num / den)


def ratio_guarded(num: Column, den: Column) -> Column:
    """Quotient where a denominator that is null, zero or negative gives null."""
    return F.when(den > 0, num.cast("double") / den.cast("double"))


def stable_mean(value: Column, scale: int = 12) -> Column:
    """Mean of the values present, the same in whatever order rows arrive.

    Adding doubles depends on the order, which a shuffle or a retried task
    changes, and a mean that lies on a rounding tie then flips. So the values are
    added as decimals of ``scale`` places, to which each is rounded first. A value
    that does not fit 28 digits with that scale, or is infinite, is an error; a
    larger ``scale`` keeps smaller fractions, a smaller one takes larger values.
    """
    present = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    kind = f"decimal(28,{scale})"
    said = F.concat(F.lit(f"out of the range of {kind}: "), present.cast("string"))
    exact = F.coalesce(present.try_cast(kind), F.raise_error(said).cast(kind))
    total = F.sum(F.when(present.isNotNull(), exact))
    return F.try_divide(total.cast("double"), F.count(present))


def sum_or_zero(value: Column) -> Column:
    """Sum of the values present; a group with none gives 0, not null."""
    return F.coalesce(F.sum(value), F.lit(0))


# Primes for spread_index; any others would do, but results depend on them.
_KEY_PRIME, _STEP, _MIX_PRIME = 1_000_003, 7_919, 999_983


def spread_index(keys: Sequence[Column], seed: int, buckets: int) -> Column:
    """A bucket in ``0 .. buckets-1`` as a pure function of integer keys.

    Integer arithmetic only: a retried task gives the same answer, and any SQL
    engine can repeat it. Keys are reduced first, so nothing can overflow. A null
    key counts as 0, so that every row has a bucket.
    """
    terms = [
        F.pmod(F.coalesce(key.cast("bigint"), F.lit(0)), F.lit(_KEY_PRIME)) * F.lit(_STEP * (i + 1))
        for i, key in enumerate(keys)
    ]
    mixed = reduce(lambda a, b: a + b, terms) + F.lit(seed)
    return F.pmod(F.pmod(mixed, F.lit(_MIX_PRIME)), F.lit(buckets)).cast("int")
