"""Strict, lenient and digit-only casts from text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from umbu.fixed_values import MISSING_CELLS, NUMBER


_MISSING = "^(?:" + "|".join(map(re.escape, MISSING_CELLS)) + r")\z"


def blank_missing(text: Column) -> Column:
    """Null in place of the cells that a CSV scan takes as missing."""
    return F.when(~text.rlike(_MISSING), text)


# A number as it is written: sign, digits before and after the point, exponent.
_WRITTEN = r"^\s*([+-]?)(\d*)(?:\.(\d*))?(?:[eE]([+-]?\d+))?\s*\z"


def try_whole(text: Column) -> Column:
    """Whole number from a number's text in any written form, null if it is none.

    Decided on the text, without a number in between that could round: the digits but
    for zeros at both ends are what the number has, and the exponent, less the places
    after the point, plus the zeros cut from the end, says how many zeros follow. Fewer
    than none means a fraction, more digits than a long has are out of range.
    """
    part = lambda k: F.regexp_extract(text, _WRITTEN, k)
    digits = F.concat(part(2), part(3))
    significant = F.regexp_replace(digits, "^0+|0+$", "")
    exponent = F.coalesce(F.nullif(part(4), F.lit("")), F.lit("0")).try_cast("int").cast("bigint")
    cut = F.length(digits) - F.length(F.regexp_replace(digits, "0+$", ""))
    zeros = exponent - F.length(part(3)) + cut
    fits = zeros.between(0, 19 - F.length(significant))
    written = F.concat(part(1), significant, F.repeat(F.lit("0"), F.when(fits, zeros).cast("int")))
    value = F.when(significant == "", F.lit(0).cast("bigint")).when(fits, written.try_cast("bigint"))
    return F.when(text.rlike(_WRITTEN) & (digits != ""), value)


def _whole(text: Column) -> Column:
    """Text of a number to whole number; a fraction or what is out of range raises."""
    said = F.concat(F.lit("no whole number: "), text)
    return F.coalesce(try_whole(text), F.raise_error(said).cast("bigint"))


def _if_needed(text: Column, rule: Callable[[Column], Column]) -> Column:
    """Apply a rule to a cell that is present, outside the generated code.

    A sheet has many columns; with a rare case written out for each of them the
    generated method outgrows what the JVM compiles, and every row is slow. In
    a lambda the rule costs the method one call.
    """
    return F.when(text.isNotNull(), F.get(F.transform(F.array(text), rule), F.lit(0)))


def strict_int(text: Column, kind: str = "int", nullable: bool = True) -> Column:
    """Whole number from text; anything else that is present fails the load.

    Plain digits, the usual cell, need a single parse. Only what is left is
    looked at for missing-value marks and for forms such as ``12.0`` or ``1e3``.
    """
    other = _if_needed(text, lambda cell: F.when(~cell.rlike(_MISSING), _whole(cell)))
    value = F.coalesce(text.try_cast("bigint"), other).cast(kind)
    if nullable:
        return value
    return F.coalesce(value, F.raise_error(F.lit("missing value")).cast(kind))


def lenient_double(text: Column) -> Column:
    """Number from text, null where it is none.

    The pattern keeps out forms only Spark would parse, such as ``1.0d``.
    """
    other = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.coalesce(text.try_cast("bigint").cast("double"), other)


def lenient_long(text: Column) -> Column:
    """Whole number from text: no number gives null; a fraction, an infinity or a
    number out of range is an error."""
    return F.coalesce(text.try_cast("bigint"), F.when(text.rlike(NUMBER), _whole(text)))


def digits_to_long(text: Column) -> Column:
    """The digits of a text as one number, null when it has none.

    Takes text: a double must be rendered by the caller, or its decimals and
    exponent would be read as digits.
    """
    return F.nullif(F.regexp_replace(text, r"[^0-9]+", ""), F.lit("")).cast("bigint")
