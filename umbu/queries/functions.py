"""Scalar functions: text, dates, numbers, casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.functions import numeric
from umbu.functions.casts import digits_to_long, lenient_double, lenient_long, strict_int, try_whole
from umbu.functions.dates import iso_date
from umbu.functions.numeric import round_half_even
from umbu.functions.text import city_key as city_key_of
from umbu.functions.text import fold
from umbu.operators.lookups import assigned_state, with_state_name
from umbu.plans.silver import SEED
from umbu.queries.registry import query
from umbu.queries.views import LISTINGS_SQL, STATES_SQL, fold_sql, listings, spread_sql, table


@query(f"SELECT doc_id, {fold_sql('text')} AS folded FROM documents")
def fold_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", fold(F.col("text")).alias("folded")
    )


@query(f"SELECT doc_id, replace({fold_sql('text')}, '_', ' ') AS city_key FROM documents")
def city_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", city_key_of(F.col("text")).alias("city_key")
    )


@query("""
SELECT o_orderkey,
       strftime(o_orderdate, '%Y-%m-%d') AS from_moment,
       strftime(o_orderdate, '%Y-%m-%d') AS from_text,
       strftime(o_orderdate, '%Y-%m-%d') AS from_pattern
FROM orders""")
def date_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        iso_date(day).alias("from_moment"),
        iso_date(day.cast("string")).alias("from_text"),
        iso_date(F.date_format(day, "dd/MM/yyyy"), "dd/MM/yyyy").alias("from_pattern"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS from_mixed
FROM orders""")
def date_mixed_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column with dates in five forms, and some that are missing."""
    forms = ["yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd", "d.M.yyyy", "yyyy-MM-dd HH:mm:ss"]
    form = F.col("o_orderkey") % len(forms)
    cell = F.coalesce(*[F.when(form == i, F.date_format("o_orderdate", p)) for i, p in enumerate(forms)])
    cells = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 > 0, cell).alias("cell"))
    return cells.select("o_orderkey", iso_date(F.col("cell"), ["yyyyMMdd", "dd/MM/yyyy", "d.M.yyyy", None]).alias("from_mixed"))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       round_even(l_extendedprice * (1 - l_discount), 2) AS two,
       round_even(l_extendedprice / (l_quantity * 1000), 6) AS six
FROM lineitem""")
def round_numpy(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        round_half_even(price * (1 - F.col("l_discount")), 2).alias("two"),
        round_half_even(price / (F.col("l_quantity") * 1000), 6).alias("six"),
    )


# Denominators from -1 to 3, or null; numerators may be zero, negative or null.
_NUM = "total % 3 - 1"
_DEN = "area % 5 - 1"
_TAG_SQL = """CASE WHEN isnan(r) THEN 'nan' WHEN isinf(r) AND r > 0 THEN 'inf'
            WHEN isinf(r) THEN '-inf' WHEN r IS NOT NULL THEN 'finite' END"""


def _kind(ratio: Column) -> Column:
    """NaN and infinities as text, so that the check need not compare them."""
    return (
        F.when(F.isnan(ratio), "nan")
        .when(ratio == float("inf"), "inf")
        .when(ratio == float("-inf"), "-inf")
        .when(ratio.isNotNull(), "finite")
    )


@query(f"""
WITH {LISTINGS_SQL}, r AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CAST({_NUM} AS DOUBLE) / CAST({_DEN} AS DOUBLE) AS r
  FROM listings)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_TAG_SQL} AS kind,
       CASE WHEN isfinite(r) THEN r END AS ratio
FROM r""")
def ratio_ieee(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = numeric.ratio_ieee(F.expr(_NUM), F.expr(_DEN))
    kind = _kind(F.col("r"))
    return (
        listings(spark, sf_dir)
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", ratio.alias("r"))
        .withColumn("kind", kind)
        .withColumn("ratio", F.when(F.col("kind") == "finite", F.col("r")))
        .drop("r")
    )


@query(f"""
WITH {LISTINGS_SQL}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN {_DEN} > 0 THEN CAST({_NUM} AS DOUBLE) / ({_DEN}) END AS ratio,
       CASE WHEN rooms > 0 THEN CAST(rent_amount AS DOUBLE) / rooms END AS per_room
FROM listings""")
def ratio_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings(spark, sf_dir).select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        numeric.ratio_guarded(F.expr(_NUM), F.expr(_DEN)).alias("ratio"),
        numeric.ratio_guarded(F.col("rent_amount"), F.col("rooms")).alias("per_room"),
    )


_ROW = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
# The last key is null in some rows, which have a state like any others.
_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "rooms"]


@query(f"""
WITH {LISTINGS_SQL}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, s.city_codigo, s.city_nome
FROM listings JOIN {STATES_SQL} ON s.i = {spread_sql(_KEYS, SEED, 20)}""")
def assign_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state for every listing from its key, and the state's name."""
    rows = listings(spark, sf_dir).select(
        *_ROW, assigned_state([F.col(k) for k in _KEYS], SEED).alias("city_codigo")
    )
    return with_state_name(rows)


# Text cells of many forms, made from a part's size.
_CELL = """CASE p_partkey % 10
  WHEN 0 THEN p_name WHEN 1 THEN '' WHEN 2 THEN ' ' || CAST(p_size AS STRING) || ' '
  WHEN 3 THEN CAST(p_size AS STRING) || 'e2' WHEN 4 THEN '+' || CAST(p_size AS STRING)
  WHEN 5 THEN 'NaN' WHEN 6 THEN CAST(p_size AS STRING) || '.0'
  WHEN 7 THEN CAST(p_size AS STRING) || 'd' WHEN 8 THEN NULL
  ELSE CAST(p_size AS STRING) END"""
_NUMBER_SQL = "CASE WHEN lower(trim(cell)) <> 'nan' THEN TRY_CAST(trim(cell) AS DOUBLE) END"


@query(f"""
WITH cells AS (SELECT p_partkey, {_CELL} AS cell FROM part)
SELECT p_partkey, {_NUMBER_SQL} AS as_double, CAST({_NUMBER_SQL} AS BIGINT) AS as_long,
       {_NUMBER_SQL} + 0.5 AS with_fraction
FROM cells""")
def cast_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "part").select("p_partkey", F.expr(_CELL).alias("cell"))
    cell = F.col("cell")
    return cells.select(
        "p_partkey",
        lenient_double(cell).alias("as_double"),
        lenient_long(cell).alias("as_long"),
        lenient_double((lenient_double(cell) + 0.5).cast("string")).alias("with_fraction"),
    )


# Cells that a load accepts: whole numbers in several forms, or missing ones.
_GOOD_CELL = """CASE p_partkey % 9
  WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN ' ' || CAST(p_size AS STRING)
  WHEN 3 THEN CAST(p_size AS STRING) || '.0' WHEN 4 THEN CAST(p_size AS STRING) || 'e0'
  WHEN 5 THEN CAST(p_size AS STRING) || '0.00e-1' WHEN 6 THEN '0.00' || CAST(p_size AS STRING) || 'E'
    || CAST(length(CAST(p_size AS STRING)) + 2 AS STRING)
  WHEN 7 THEN '+' || CAST(p_size AS STRING) || '000000000000000000000e-21'
  ELSE CAST(p_size AS STRING) END"""


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 9 > 1 THEN p_size END AS size,
       CAST(p_partkey AS BIGINT) AS part_number
FROM part""")
def cast_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "part").withColumn("cell", F.expr(_GOOD_CELL))
    return cells.select(
        "p_partkey",
        strict_int(F.col("cell")).alias("size"),
        strict_int(F.col("p_partkey").cast("string"), "bigint", nullable=False).alias(
            "part_number"
        ),
    )


# Forms of numbers that are whole, are not, or are out of a long's range.
_FORM = """CASE p_partkey % 12
  WHEN 0 THEN CAST(p_size AS STRING) || 'e3' WHEN 1 THEN '-' || CAST(p_size AS STRING) || '.50e1'
  WHEN 2 THEN CAST(p_size AS STRING) || '.0000000000000000000000001' WHEN 3 THEN CAST(p_size AS STRING) || 'e-20'
  WHEN 4 THEN CAST(p_size AS STRING) || '.0000000000000000001e0' WHEN 5 THEN CAST(p_size AS STRING) || 'e25'
  WHEN 6 THEN '0e99999999999' WHEN 7 THEN '.' || CAST(p_size AS STRING) || 'e1'
  WHEN 8 THEN '92233720368547758' || CASE WHEN p_size % 2 = 0 THEN '07' ELSE '08' END
  WHEN 9 THEN '-92233720368547758.08E+2' WHEN 10 THEN p_name ELSE NULL END"""


@query(f"""
WITH cells AS (SELECT p_partkey, p_size, {_FORM} AS cell FROM part)
SELECT p_partkey, cell, CASE p_partkey % 12
  WHEN 0 THEN CAST(p_size AS BIGINT) * 1000 WHEN 1 THEN CAST(p_size AS BIGINT) * -10 - 5 WHEN 6 THEN 0
  WHEN 7 THEN CASE WHEN p_size < 10 THEN p_size WHEN p_size % 10 = 0 THEN p_size // 10 END
  WHEN 8 THEN CASE WHEN p_size % 2 = 0 THEN 9223372036854775807 END
  WHEN 9 THEN -9223372036854775807 - 1 END AS whole
FROM cells""")
def cast_written_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which cells are whole numbers, whatever way they are written."""
    cells = table(spark, sf_dir, "part").select("p_partkey", F.expr(_FORM).alias("cell"))
    return cells.withColumn("whole", try_whole(F.col("cell")))


@query("""
SELECT c_custkey,
       TRY_CAST(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') AS BIGINT) AS from_name,
       TRY_CAST(nullif(regexp_replace(c_mktsegment, '[^0-9]', '', 'g'), '') AS BIGINT)
         AS from_segment,
       CAST(floor(abs(c_acctbal)) AS BIGINT) * 10 + 1 AS from_marked
FROM customer""")
def digits_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digits of names, of text without any, and of numbers with separators."""
    units = F.floor(F.abs("c_acctbal"))
    thousands, rest = F.floor(units / 1000), units % 1000
    marked = F.format_string("%d.%03d (1)", thousands, rest)
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        digits_to_long(F.col("c_name")).alias("from_name"),
        digits_to_long(F.col("c_mktsegment")).alias("from_segment"),
        digits_to_long(marked).alias("from_marked"),
    )
