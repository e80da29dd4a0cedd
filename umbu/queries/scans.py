"""Files and loads: written to the shared folder, then read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.fixed_values import MUNICIPALITY_HEADERS
from umbu.plans import bronze
from umbu.queries.bronze import (
    LOAD,
    MUNICIPALITIES_SQL,
    POPULATION_UF_SQL,
    RENT_NAMES,
    WIDE_PRICES_SQL,
    municipality_sheet,
    raw_listings,
    raw_prices,
    uf_sheet,
)
from umbu.queries.registry import query
from umbu.queries.views import (
    LISTINGS_SQL,
    PRICES_SQL,
    listings,
    load_dates,
    prices,
    table,
    year_start,
)
from umbu.schemas import BRONZE_BASKET, BRONZE_RENT, LOAD_DATE, SILVER_BASKET
from umbu.sources.landing import QUOTING, scan_csv, scan_sheet, scan_sheet_columns
from umbu.sources.loads import (
    LoadReport,
    load_outcomes,
    load_path,
    path_load_date,
    read_loads,
    read_table,
    write_loads,
)
from umbu.sources.shared import scratch_folder


@query(f"""
WITH {LISTINGS_SQL}
SELECT {", ".join(RENT_NAMES)}, '{LOAD}' AS data_carga FROM listings""")
def scan_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings landed as CSV files with a header, scanned and typed."""
    folder = scratch_folder(spark, "csv")
    raw_listings(spark, sf_dir).write.mode("overwrite").csv(folder, header=True, **QUOTING)
    return bronze.bronze_rent(scan_csv(spark, folder), LOAD)


@query(WIDE_PRICES_SQL)
def scan_wide_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price sheet landed as CSV, with dates of another form, scanned and unpivoted."""
    folder = scratch_folder(spark, "prices")
    sheet = raw_prices(spark, sf_dir).withColumn("Data", F.date_format("Data", "dd/MM/yyyy"))
    sheet.write.mode("overwrite").csv(folder, header=True, **QUOTING)
    return bronze.bronze_basket(scan_csv(spark, folder), LOAD, "dd/MM/yyyy")


def _land_sheets(sheet: DataFrame, folder: str, titles: Sequence[str], preamble: int) -> None:
    """Write a frame as sheets: each file has title lines, headers, then rows."""
    top = ["ESTIMATIVAS DA POPULAÇÃO"] * preamble + [",".join(["NOTA", *titles])]

    def with_top(batches):
        import pyarrow as pa

        yield pa.RecordBatch.from_pydict({"value": top})
        yield from batches

    cells = F.struct(F.lit("x").alias("nota"), *sheet.columns)
    lines = sheet.select(F.to_csv(cells, QUOTING).alias("value"))
    lines.mapInArrow(with_top, "value string").write.mode("overwrite").text(folder)


@query(MUNICIPALITIES_SQL)
def skip_preamble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets with a title line above the headers; five columns are picked."""
    folder = scratch_folder(spark, "sheets")
    titles = [title for title, _ in MUNICIPALITY_HEADERS]
    _land_sheets(municipality_sheet(spark, sf_dir), folder, titles, 1)
    sheet = scan_sheet_columns(spark, folder, 1, dict(MUNICIPALITY_HEADERS))
    return bronze.bronze_population_mun(sheet, LOAD)


@query(POPULATION_UF_SQL)
def skip_preamble_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets with two title lines; two columns are taken by position."""
    folder = scratch_folder(spark, "sheets")
    _land_sheets(uf_sheet(spark, sf_dir), folder, ["UNIDADE", "POPULAÇÃO"], 2)
    sheet = scan_sheet(spark, folder, 2, ["note", "name", "people"]).select("name", "people")
    return bronze.bronze_population_uf(sheet, LOAD)


@query(f"""
WITH {LISTINGS_SQL}
SELECT {", ".join(RENT_NAMES)}, load AS data_carga
FROM listings, (VALUES ('2024-01-01'), ('2025-01-01')) AS loads(load)""")
def scan_old_and_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads read together, one with wide whole numbers and one with narrow ones."""
    root, loads = scratch_folder(spark, "loads"), ["2024-01-01", "2025-01-01"]
    rows = listings(spark, sf_dir).select(*RENT_NAMES)
    wide = [F.col(n).cast("bigint").alias(n) if t == "int" else F.col(n) for n, t in rows.dtypes]
    for day, held in zip(loads, (rows.select(*wide), rows)):
        held.write.parquet(load_path(root, BRONZE_RENT, day))
    return read_loads(spark, root, BRONZE_RENT, loads)


@query(f"""
WITH {LISTINGS_SQL}
SELECT {", ".join(RENT_NAMES)}, load AS data_carga
FROM listings, (VALUES ('2023-01-01'), ('2024-01-01'), ('2025-01-01')) AS loads(load)""")
def scan_loads_of_three_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads read together: whole numbers narrow, wide, and as fractions and
    decimals, with columns in another order and one more."""
    root, rows = scratch_folder(spark, "loads"), listings(spark, sf_dir).select(*RENT_NAMES)
    kinds = {"2023-01-01": ["int"], "2024-01-01": ["bigint"], "2025-01-01": ["double", "decimal(12,0)"]}
    for day, of in kinds.items():
        cells = [
            F.col(n).cast(of[i % len(of)]).alias(n) if t == "int" else F.col(n)
            for i, (n, t) in enumerate(rows.dtypes)
        ]
        rows.select(F.lit("x").alias("note"), *reversed(cells)).write.parquet(load_path(root, BRONZE_RENT, day))
    return read_loads(spark, root, BRONZE_RENT, list(kinds))


@query(f"""
WITH {PRICES_SQL}, days AS (SELECT unnest(range(1990, 2001)) || '-01-01' AS load),
held AS (SELECT DISTINCT data_carga FROM prices)
SELECT load, held.data_carga IS NOT NULL AS found,
       CASE WHEN held.data_carga IS NULL THEN 'no Parquet file' END AS problem
FROM days LEFT JOIN held ON held.data_carga = load""")
def missing_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What asking for each load of a calendar meets: the load, or an error.

    The outcome table says which are there; reading one that is not must raise.
    """
    root = scratch_folder(spark, "loads")
    dates = load_dates(spark, sf_dir, "orders", "o_orderdate")
    write_loads(prices(spark, sf_dir), root, BRONZE_BASKET, dates)
    outcomes = load_outcomes(spark, root, BRONZE_BASKET, [f"{year}-01-01" for year in range(1990, 2001)])
    absent = sorted(r["load"] for r in outcomes.where("not found").collect())
    for day in absent[:1] + absent[-1:]:
        try:
            read_loads(spark, root, BRONZE_BASKET, day)
        except FileNotFoundError:
            continue
        raise AssertionError(f"load {day} is not there and was read")
    problem = F.when(~F.col("found"), F.lit("no Parquet file"))
    return outcomes.select("load", "found", problem.alias("problem"))


@query(f"""
WITH {PRICES_SQL}
SELECT data_mes, cidade, valor, data_carga FROM prices
WHERE data_carga = (SELECT max(data_carga) FROM prices)""")
def scan_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load out of all that were written."""
    root = scratch_folder(spark, "loads")
    dates = load_dates(spark, sf_dir, "orders", "o_orderdate")
    write_loads(prices(spark, sf_dir), root, BRONZE_BASKET, dates)
    return read_loads(spark, root, BRONZE_BASKET, dates[-1])


@query(f"""
WITH {PRICES_SQL}
SELECT data_mes, cidade, data_carga,
       CASE WHEN data_carga = (SELECT max(data_carga) FROM prices) THEN -valor ELSE valor END
         AS valor
FROM prices""")
def write_overwrite_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All loads written, the last one written again with other values."""
    root = scratch_folder(spark, "loads")
    dates = load_dates(spark, sf_dir, "orders", "o_orderdate")
    rows = prices(spark, sf_dir)
    write_loads(rows, root, BRONZE_BASKET, dates)
    again = rows.where(F.col(LOAD_DATE) == dates[-1]).withColumn("valor", -F.col("valor"))
    write_loads(again, root, BRONZE_BASKET, dates[-1])
    return read_table(spark, root, BRONZE_BASKET)


def report_frame(spark: SparkSession, reports: list[LoadReport]) -> DataFrame:
    """Load reports as a frame, one row per write."""
    rows = [
        (r.table, r.rows, len(r.loads), ", ".join(f"{c} {t}" for c, t in r.columns))
        for r in reports
    ]
    return spark.createDataFrame(
        rows, "table_name string, row_count bigint, load_count bigint, column_types string"
    )


@query(f"""
WITH {PRICES_SQL}
SELECT 'bronze.cesta_basica' AS table_name, count(*) AS row_count,
       count(DISTINCT data_carga) AS load_count,
       'data_mes string, cidade string, valor double, data_carga string' AS column_types
FROM prices""")
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a write reports: rows counted on the way, column types."""
    root = scratch_folder(spark, "loads")
    dates = load_dates(spark, sf_dir, "orders", "o_orderdate")
    report = write_loads(prices(spark, sf_dir), root, BRONZE_BASKET, dates)
    return report_frame(spark, [report])


@query("""
SELECT o_orderkey,
       'lake/silver/cesta_basica_full/data_carga='
         || strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') || '/part-0.parquet' AS path,
       strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS load_date
FROM orders""")
def partition_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of loads built from dates, and the dates read out of them again."""
    start = F.lit(f"{SILVER_BASKET.location('lake')}/{LOAD_DATE}=")
    path = F.concat(start, year_start(F.col("o_orderdate")), F.lit("/part-0.parquet"))
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", path.alias("path"))
        .withColumn("load_date", path_load_date(F.col("path")))
    )
