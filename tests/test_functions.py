import math
import unicodedata

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from umbu.functions.casts import digits_to_long, lenient_double, lenient_long, strict_int, try_whole
from umbu.functions.dates import iso_date, load_calendar, load_date
from umbu.functions.numeric import (
    ratio_guarded,
    ratio_ieee,
    round_half_even,
    spread_index,
    stable_mean,
    sum_or_zero,
)
from umbu.functions.text import city_key, fold


def column(frame, values, kind, rule):
    """A rule applied to values, in their order."""
    numbered = frame(list(enumerate(values)), f"i int, x {kind}")
    rows = numbered.select("i", rule(F.col("x")).alias("y"))
    return [row["y"] for row in sorted(rows.collect())]


def plain_fold(text):
    return "".join(filter(str.isascii, unicodedata.normalize("NFKD", text))).lower().strip()


def test_fold(frame):
    cases = ["São Luís ", "BELÉM", "½ß", None, "\t x\x1f\n", "", "ﬁn ⑽ ﷺ Ĳ 𝐀𝐛 🄐 가 é", " a　"]
    expected = ["sao luis", "belem", "12", None, "x", ""]
    found = column(frame, cases, "string", fold)
    assert found[:6] == expected
    assert found == [None if c is None else plain_fold(c) for c in cases]


def test_fold_every_character(frame):
    """Each character of Unicode, in the middle of a text."""
    codes = [*range(1, 0xD800), *range(0xE000, 0x110000)]
    texts = ["".join(f"{chr(c)}|" for c in codes[i : i + 64]) for i in range(0, len(codes), 64)]
    assert column(frame, texts, "string", fold) == [plain_fold(t) for t in texts]


def test_city_key(frame):
    assert column(frame, ["são_paulo", "Rio_De_Janeiro ", None], "string", city_key) == [
        "sao paulo", "rio de janeiro", None,
    ]


def test_digits(frame):
    cases = ["1.234(5)", "nan", "", None, "11.0"]
    assert column(frame, cases, "string", digits_to_long) == [12345, None, None, None, 110]


def test_strict_int(frame):
    cases = ["12", " 7 ", "12.0", "1e3", "+5", "NA", "", None, "nan"]
    expected = [12, 7, 12, 1000, 5, None, None, None, None]
    assert column(frame, cases, "string", strict_int) == expected


@pytest.mark.parametrize("bad", ["1.5", "abc", "1.0d", "inf", "1_000", "99999999999"])
def test_strict_int_refuses(frame, bad):
    with pytest.raises(PySparkException):
        column(frame, ["1", bad], "string", strict_int)


def test_strict_int_needs_a_value(frame):
    with pytest.raises(PySparkException, match="missing value"):
        column(frame, ["1", None], "string", lambda c: strict_int(c, nullable=False))


def test_lenient_double_is_pandas_to_numeric(frame):
    cases = [
        "12", "12.5", " 12 ", "1e3", "+5", "inf", "-inf", "x", "", "-", "0x10", "1.0d", "1_000",
        "NaN", ".5", "5.", "1e", None,
    ]
    expected = pd.to_numeric(pd.Series(cases, dtype=object), errors="coerce")
    found = column(frame, cases, "string", lenient_double)
    assert found == [None if math.isnan(v) else v for v in expected]


def test_lenient_long(frame):
    cases = ["12", "12.0", "1e3", "x", "", None, "9007199254740993"]
    assert column(frame, cases, "string", lenient_long) == [
        12, 12, 1000, None, None, None, 9007199254740993,
    ]
    with pytest.raises(PySparkException):
        column(frame, ["2.5"], "string", lenient_long)


def test_iso_date(frame):
    cases = ["2024-03-01", "2024-03-01 10:11:12", None]
    assert column(frame, cases, "string", iso_date) == ["2024-03-01", "2024-03-01", None]
    by_pattern = column(frame, ["31/12/2023"], "string", lambda c: iso_date(c, "dd/MM/yyyy"))
    assert by_pattern == ["2023-12-31"]
    with pytest.raises(PySparkException):
        column(frame, ["soon"], "string", iso_date)


def test_iso_date_of_mixed_forms(frame):
    forms = ["dd/MM/yyyy", "MM-dd-yyyy", None]
    cases = ["31/12/2023", "12-31-2023", "2023-12-31", "2023-12-31 23:59:59", None]
    mixed = lambda c: iso_date(c, forms)
    assert column(frame, cases, "string", mixed) == ["2023-12-31"] * 4 + [None]
    for bad in ("soon", "31-31-2023", ""):
        with pytest.raises(PySparkException, match="no date"):
            column(frame, ["31/12/2023", bad], "string", mixed)


def test_load_date():
    assert load_date("2025-05-01") == "2025-05-01"
    with pytest.raises(ValueError):
        load_date("2025-05-01' OR 1=1")


def test_load_calendar():
    assert load_calendar("2024-12-15", "2025-02-01") == ["2025-01-01", "2025-02-01"]
    assert load_calendar("2024-02-28", "2024-03-01", "day") == [
        "2024-02-28", "2024-02-29", "2024-03-01",
    ]
    with pytest.raises(ValueError):
        load_calendar("2024-01-01", "2024-02-01", "week")


def test_round_is_numpy_round(frame):
    cases = [0.125, 0.375, 1.005, 1.255, 0.285, None]
    found = column(frame, cases, "double", lambda c: round_half_even(c, 2))
    assert found == [0.12, 0.38, 1.0, 1.25, 0.28, None]
    values = np.round(np.random.default_rng(1).uniform(-1e6, 1e6, 20000), 3)
    for digits in (2, 6):
        found = column(
            frame, values.tolist(), "double", lambda c, d=digits: round_half_even(c, d)
        )
        assert found == np.round(values, digits).tolist()


def test_ratio_ieee(frame):
    rows = [(1, 0), (0, 0), (-1, 0), (3, 2), (None, 0), (1, None)]
    df = frame([(i, *r) for i, r in enumerate(rows)], "i int, a int, b int")
    found = df.orderBy("i").select(ratio_ieee(F.col("a"), F.col("b")).alias("r")).collect()
    found = [row["r"] for row in found]
    assert math.isnan(found.pop(1))
    assert found == [math.inf, -math.inf, 1.5, None, None]


def test_ratio_guarded(frame):
    rows = [(0, 10, 0), (1, 10, None), (2, 10, -2), (3, 10, 4), (4, None, 4)]
    df = frame(rows, "i int, a int, b int")
    found = df.orderBy("i").select(ratio_guarded(F.col("a"), F.col("b")).alias("r")).collect()
    assert [row["r"] for row in found] == [None, None, None, 2.5, None]


def test_stable_mean(frame):
    nan = math.nan
    rows = [("a", 0.1), ("a", 0.2), ("a", None), ("a", nan), ("b", None), ("d", -1.25), ("d", 1.0)]
    rows += [("e", 1e15), ("e", 3e15), ("g", 1e-7), ("g", 3e-7), ("h", 1.4e-6), ("h", 1.8e-6), ("h", 1.4e-6)]
    df = frame(rows, "k string, x double").groupBy("k").agg(stable_mean(F.col("x")).alias("m"))
    found = {row["k"]: row["m"] for row in df.collect()}
    assert round(found.pop("h"), 6) == 2e-6
    assert found == {"a": 0.15, "b": None, "d": -0.125, "e": 2e15, "g": 2e-7}


@pytest.mark.parametrize("bad", [math.inf, -math.inf, 1e17])
def test_stable_mean_out_of_range(frame, bad):
    with pytest.raises(Exception, match="out of the range"):
        frame([(bad,), (1.0,)], "x double").agg(stable_mean(F.col("x"))).collect()
    if math.isfinite(bad):
        wider = frame([(bad,), (bad,)], "x double").agg(stable_mean(F.col("x"), 6).alias("m"))
        assert wider.first()["m"] == bad


@pytest.mark.parametrize("cast", [lenient_long, strict_int])
@pytest.mark.parametrize(
    "bad",
    ["1e25", "inf", "5.0000000000000000001", "99999999999999999999", "1e-20", "5.0000000000000000001e0", "1e-99999999999"],
)
def test_whole_numbers_are_never_cut(frame, cast, bad):
    with pytest.raises(Exception):
        column(frame, ["1", bad], "string", cast)


def test_whole_numbers_in_any_written_form(frame):
    """Against whole-number arithmetic, for all short forms of sign, digits and exponent."""
    cells = [
        f"{sign}{before}{after}{power}"
        for sign in ("", "+", "-")
        for before in ("", "0", "7", "12", "100", "9223372036854775807", "9223372036854775808", "00000000000000000000012")
        for after in ("", ".", ".0", ".5", ".50", ".000000000000000000000000001", ".25")
        for power in ("", "e0", "E3", "e-1", "e+2", "e-2", "e18", "e40", "e-40", "e99999999999999")
    ]
    from fractions import Fraction

    def whole(cell):
        number, _, power = cell.lower().partition("e")
        digits = number.lstrip("+-")
        before, _, after = digits.partition(".")
        if not before + after:
            return None
        if int(before + after) == 0:
            return 0
        if abs(int(power or 0)) > 1000:
            return None
        value = Fraction(int(before + after)) * Fraction(10) ** (int(power or 0) - len(after))
        value = -value if number.startswith("-") else value
        return int(value) if value.denominator == 1 and -(2**63) <= value < 2**63 else None

    found = column(frame, cells, "string", try_whole)
    assert [(c, v) for c, v in zip(cells, found) if v != whole(c)] == []
    others = ["", " ", "x", "1 2", "1e", "e5", ".", "+", "1.2.3", "0x1", "1_0", "inf", "nan", "١", None]
    assert column(frame, others, "string", try_whole) == [None] * len(others)


def test_a_null_key_has_a_bucket(frame):
    df = frame([(None, 1), (0, 1), (None, None)], "a int, b int")
    found = [r["s"] for r in df.select(spread_index([F.col("a"), F.col("b")], 7, 20).alias("s")).collect()]
    assert found[0] == found[1] and all(0 <= s < 20 for s in found)


def test_stable_mean_does_not_depend_on_order(spark):
    """Prices whose plain sum changes with the order of rows."""
    rows = spark.range(40000).select((F.pmod(F.xxhash64("id"), F.lit(10**9)) / 100).alias("x"))
    means = {
        rows.repartition(n, "x").agg(stable_mean(F.col("x")).alias("m")).first()["m"]
        for n in (1, 3, 7, 13)
    }
    assert len(means) == 1


def test_sum_or_zero(frame):
    df = frame([("a", 1), ("a", None), ("b", None)], "k string, x int")
    found = df.groupBy("k").agg(sum_or_zero(F.col("x")).alias("s")).collect()
    assert {row["k"]: row["s"] for row in found} == {"a": 1, "b": 0}


@pytest.mark.parametrize("step", [1, 20, 1000])
def test_spread_is_even_and_repeatable(spark, step):
    rows = spark.range(0, 200000 * step, step)
    bucket = spread_index([F.col("id")], 7, 20)
    counts = rows.groupBy(bucket.alias("b")).count().collect()
    assert len(counts) == 20
    assert all(abs(row["count"] - 10000) < 500 for row in counts)
    big = spark.range(1).select(spread_index([F.lit(2**63 - 1), F.lit(-(2**63))], 7, 20).alias("b"))
    assert 0 <= big.first()["b"] < 20
