import csv

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from umbu import schemas as S
from umbu.plans.runs import Lake
from umbu.schemas import BRONZE_BASKET, BRONZE_POP_MUN, GOLD_BASKET, LOAD_DATE, TABLES
from umbu.sources import catalog, landing
from umbu.sources.landing import scan_csv, scan_sheet_columns
from umbu.sources.loads import (
    load_outcomes,
    load_path,
    path_load_date,
    read_loads,
    read_table,
    write_loads,
)
from umbu.sources.shared import SETTING, scratch_folder

D1, D2, D3 = "2025-05-01", "2025-06-01", "2025-07-01"
BASKET = "data_mes string, cidade string, valor double, data_carga string"


def prices(frame, *loads, valor=1.0):
    return frame([("2025-01-01", f"c{i}", valor, d) for d in loads for i in range(3)], BASKET)


def by_load(df):
    return {r[LOAD_DATE]: (r["n"], r["v"]) for r in df.groupBy(LOAD_DATE).agg(
        F.count(F.lit(1)).alias("n"), F.sum("valor").alias("v")).collect()}


def test_write_replaces_only_its_loads(spark, frame, tmp_path):
    root = str(tmp_path)
    report = write_loads(prices(frame, D1, D2), root, BRONZE_BASKET, [D1, D2])
    assert (report.table, report.rows) == ("bronze.cesta_basica", 6)
    assert report.loads == (D1, D2)
    assert report.columns == tuple(
        (c, "string" if c != "valor" else "double")
        for c in ("data_mes", "cidade", "valor", LOAD_DATE)
    )
    write_loads(prices(frame, D1, valor=5.0), root, BRONZE_BASKET, D1)
    expected = {D1: (3, 15.0), D2: (3, 3.0)}
    assert by_load(read_table(spark, root, BRONZE_BASKET)) == expected
    write_loads(prices(frame, D1, valor=5.0), root, BRONZE_BASKET, D1)
    assert by_load(read_table(spark, root, BRONZE_BASKET)) == expected


def test_read_lists_only_the_loads_asked_for(spark, frame, tmp_path):
    root = str(tmp_path)
    write_loads(prices(frame, D1, D2, D3), root, BRONZE_BASKET, [D1, D2, D3])
    assert by_load(read_loads(spark, root, BRONZE_BASKET, D2)) == {D2: (3, 3.0)}
    assert set(by_load(read_loads(spark, root, BRONZE_BASKET, [D1, D3]))) == {D1, D3}
    assert read_loads(spark, root, BRONZE_BASKET, D1).schema == BRONZE_BASKET.struct
    files = read_loads(spark, root, BRONZE_BASKET, D2).inputFiles()
    assert files and all(f"{LOAD_DATE}={D2}" in f for f in files)


def test_table_scan_prunes_loads_and_columns(spark, frame, tmp_path):
    root = str(tmp_path)
    write_loads(prices(frame, D1, D2), root, BRONZE_BASKET, [D1, D2])
    df = read_table(spark, root, BRONZE_BASKET).where(F.col(LOAD_DATE) == D1)
    plan = df.where("valor > 0").select("valor")._jdf.queryExecution().executedPlan().toString()
    assert f"{LOAD_DATE}" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThan(valor,0.0)" in plan and "ReadSchema: struct<valor:double>" in plan


def test_missing_load_raises(spark, frame, tmp_path):
    root = str(tmp_path)
    write_loads(prices(frame, D1), root, BRONZE_BASKET, D1)
    with pytest.raises(FileNotFoundError):
        read_loads(spark, root, BRONZE_BASKET, D2)
    (tmp_path / BRONZE_BASKET.folder / f"{LOAD_DATE}={D3}").mkdir()
    (tmp_path / BRONZE_BASKET.folder / f"{LOAD_DATE}={D3}" / "notes.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        read_loads(spark, root, BRONZE_BASKET, D3)


def test_empty_result(spark, frame, tmp_path):
    root = str(tmp_path)
    write_loads(prices(frame, D1), root, BRONZE_BASKET, D1)
    nothing = prices(frame, D1).limit(0)
    assert write_loads(nothing, root, BRONZE_BASKET, D1).rows == 0
    assert by_load(read_loads(spark, root, BRONZE_BASKET, D1)) == {D1: (3, 3.0)}
    write_loads(nothing, root, BRONZE_BASKET, D1, keep_empty=True)
    assert read_loads(spark, root, BRONZE_BASKET, D1).isEmpty()


@pytest.mark.parametrize("clustered", [False, True])
def test_some_of_the_loads_are_empty(spark, frame, tmp_path, clustered):
    root = str(tmp_path)
    write_loads(prices(frame, D1, D2, D3), root, BRONZE_BASKET, [D1, D2, D3])
    some = prices(frame, D3, valor=2.0)
    report = write_loads(some, root, BRONZE_BASKET, [D3, D2], clustered=clustered)
    assert (report.rows, report.loads) == (3, (D3,))
    expected = {D1: (3, 3.0), D2: (3, 3.0), D3: (3, 6.0)}
    assert by_load(read_table(spark, root, BRONZE_BASKET)) == expected
    report = write_loads(some, root, BRONZE_BASKET, [D3, D2], True, clustered)
    assert (report.rows, report.loads) == (3, (D2, D3))
    del expected[D2]
    assert by_load(read_table(spark, root, BRONZE_BASKET)) == expected
    assert read_loads(spark, root, BRONZE_BASKET, [D2, D3]).count() == 3


def test_files_with_wider_types_can_be_read(spark, tmp_path):
    """Loads written elsewhere: 64-bit integers, the load date in the file too."""
    folder = tmp_path / BRONZE_POP_MUN.folder / f"{LOAD_DATE}={D1}"
    folder.mkdir(parents=True)
    pq.write_table(
        pa.table({"uf": ["RJ", "AM"], "cod_uf": [33, 13], "cod_municipio": [1, 2],
                  "municipio": ["Rio", "Manaus"], "populacao": pa.array([7, None], pa.int64()),
                  LOAD_DATE: [D1, D1]}),
        folder / "populacao_municipios.parquet",
    )
    df = read_loads(spark, str(tmp_path), BRONZE_POP_MUN, D1)
    assert df.schema == BRONZE_POP_MUN.struct
    assert sorted(map(tuple, df.collect())) == [
        ("AM", 13, 2, "Manaus", None, D1), ("RJ", 33, 1, "Rio", 7, D1),
    ]


def test_many_loads_are_written_without_small_files(spark, frame, tmp_path):
    wide = spark.range(0, 5000, 1, 16).selectExpr(
        "'2025-01-01' data_mes", "cast(id as string) cidade", "double(id) valor",
        f"if(id % 3 = 0, '{D1}', '{D2}') {LOAD_DATE}",
    )
    write_loads(wide, str(tmp_path), BRONZE_BASKET, [D1, D2])
    for date in (D1, D2):
        folder = tmp_path / BRONZE_BASKET.folder / f"{LOAD_DATE}={date}"
        assert len(list(folder.glob("*.parquet"))) == 1


def test_paths(frame):
    assert load_path("s3a://lake/", GOLD_BASKET, D1) == (
        f"s3a://lake/gold/cesta_basica_gold/{LOAD_DATE}={D1}"
    )
    df = frame([(f"/x/{LOAD_DATE}={D1}/f.parquet",), ("/x/y",)], "p string")
    assert [r[0] for r in df.select(path_load_date(F.col("p"))).collect()] == [D1, None]


def test_catalog(spark, frame, tmp_path):
    lake = Lake(spark, str(tmp_path), "test_catalog_")
    lake.create_catalog()
    lake.create_catalog()
    for table in TABLES:
        found = spark.table(catalog.table_name(table, lake.prefix))
        assert found.dtypes == [*table.columns, (LOAD_DATE, "string")]
        assert found.isEmpty()
    write_loads(prices(frame, D1, D2, D3), lake.root, BRONZE_BASKET, [D1, D2, D3])
    for _ in range(2):
        catalog.register_loads(spark, lake.root, BRONZE_BASKET, [D1], lake.prefix)
    assert set(by_load(lake.table(BRONZE_BASKET))) == {D1}
    catalog.repair_table(spark, BRONZE_BASKET, lake.prefix)
    assert by_load(lake.table(BRONZE_BASKET)) == {d: (3, 3.0) for d in (D1, D2, D3)}
    plan = lake.table(BRONZE_BASKET).where(F.col(LOAD_DATE) == D1).select("valor")
    assert "PartitionFilters: [isnotnull(data_carga" in plan._jdf.queryExecution().toString()


def test_scan_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Id,City Name,Rent-Amount\n1,"São, Paulo",10\n2,,NA\n')
    (tmp_path / "b.csv").write_text("Id,City Name,Rent-Amount\n3,x,30\n")
    (tmp_path / "readme.txt").write_text("not,a,table\n")
    df = landing.scan_csv(spark, str(tmp_path))
    assert df.columns == ["Id", "City Name", "Rent-Amount"]
    assert sorted(map(tuple, df.collect())) == [
        ("1", "São, Paulo", "10"), ("2", None, "NA"), ("3", "x", "30"),
    ]
    named = landing.scan_csv(spark, str(tmp_path), ["Id", "City Name", "Rent-Amount"])
    assert sorted(named.collect()) == sorted(df.collect())


def sheet(path, title_lines, header, body):
    with open(path, "w", newline="") as out:
        for line in title_lines:
            out.write(line + "\n")
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(header)
        writer.writerows(body)


def test_scan_sheet_in_pieces(spark, tmp_path):
    """Files of several pieces, where only the first piece has a preamble."""
    body = [[f"uf {i:05d}", f'{i}.000 "x", y'] for i in range(3000)]
    for part in range(3):
        sheet(tmp_path / f"s{part}.csv", ["TITLE", "a,b,c"], ["Name", "People"], body[part::3])
    sheet(tmp_path / "top.csv", ["TITLE", "a,b,c"], ["Name", "People"], [])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        df = landing.scan_sheet(spark, str(tmp_path), 2, ["name", "people"])
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 6
        assert sorted(map(list, df.collect())) == body
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_scan_sheet_columns(spark, tmp_path):
    path = tmp_path / "m.csv"
    sheet(path, ["TITLE"], ["Note", "COD. UF", "População"], [["x", "33", "1.000"], ["", "", "-"]])
    df = landing.scan_sheet_columns(spark, str(path), 1, {"População": "pop", "COD. UF": "uf"})
    assert df.columns == ["pop", "uf"]
    assert sorted(map(tuple, df.collect()), key=str) == [("-", None), ("1.000", "33")]
    with pytest.raises(ValueError, match="Missing"):
        landing.scan_sheet_columns(spark, str(path), 1, {"Missing": "m"})


def test_scratch_folder(spark):
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first != second and first.startswith(spark.conf.get(SETTING))


def land(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def fails(df):
    with pytest.raises(Exception) as problem:
        df.collect()
    return str(problem.value)


def test_csv_of_other_headers_or_cells_fails(spark, tmp_path):
    mixed = land(tmp_path / "mixed", a="id,city\n1,x\n", b="city,id\ny,2\n")
    fails(scan_csv(spark, mixed))
    fails(scan_csv(spark, mixed, ["id", "city"]).select("city"))
    extra = land(tmp_path / "extra", a="id,city\n1,x,EXTRA\n")
    fails(scan_csv(spark, extra))
    fails(scan_csv(spark, extra).select("id"))


def test_csv_line_breaks_need_multi_line(spark, tmp_path):
    folder = land(tmp_path / "breaks", a='id,city\n1,"two\nlines"\n')
    fails(scan_csv(spark, folder))
    assert [tuple(r) for r in scan_csv(spark, folder, multi_line=True).collect()] == [("1", "two\nlines")]


def test_sheets_of_other_headers_or_cells_fail(spark, tmp_path):
    good = land(tmp_path / "good", a="t\nid,city\n1,x\n2,y\n", b="t\nid,city\n3,z\n")
    df = scan_sheet_columns(spark, good, 1, {"city": "c"})
    assert sorted(r["c"] for r in df.collect()) == ["x", "y", "z"]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    mixed = land(tmp_path / "mixed", a="t\nid,city\n1,x\n", b="t\ncity,id\nx,1\n")
    assert "header" in fails(scan_sheet_columns(spark, mixed, 1, {"city": "c"}))
    fails(scan_sheet_columns(spark, land(tmp_path / "extra", a="t\nid,city\n1,x,9\n"), 1, {"city": "c"}))


BASKET_ROW = "data_mes string, cidade string, valor double, data_carga string"


@pytest.mark.parametrize("stray", ["2025-02-01", None])
def test_a_stray_row_fails_the_write_and_leaves_all_loads(spark, frame, tmp_path, stray):
    root = str(tmp_path)
    rows = [("m", "a", 1.0, "2025-01-01"), ("m", "b", 2.0, "2025-02-01")]
    write_loads(frame(rows, BASKET_ROW), root, S.BRONZE_BASKET, ["2025-01-01", "2025-02-01"])
    again = frame([("m", "c", 3.0, "2025-01-01"), ("m", "d", 4.0, stray)], BASKET_ROW)
    with pytest.raises(Exception, match="not to be written"):
        write_loads(again, root, S.BRONZE_BASKET, "2025-01-01")
    assert sorted(tuple(r) for r in read_table(spark, root, S.BRONZE_BASKET).collect()) == rows


def test_loads_far_apart_are_reported(spark, frame, tmp_path):
    dates = ["1900-01-01", "2025-05-01"]
    df = frame([("m", "a", 1.0, d) for d in dates], BASKET_ROW)
    report = write_loads(df, str(tmp_path), S.BRONZE_BASKET, dates)
    assert report.loads == tuple(dates) and report.rows == 2


def test_one_missing_load_of_several_is_noticed(spark, frame, tmp_path):
    root = str(tmp_path)
    write_loads(frame([("m", "a", 1.0, "2025-01-01")], BASKET_ROW), root, S.BRONZE_BASKET, "2025-01-01")
    empty = tmp_path / "bronze/dieese/cesta_basica/data_carga=2025-02-01"
    empty.mkdir()
    (empty / "note.txt").write_text("no table")
    with pytest.raises(FileNotFoundError, match="2025-02-01"):
        read_loads(spark, root, S.BRONZE_BASKET, ["2025-01-01", "2025-02-01"])


@pytest.mark.parametrize("wide", [0, 1])
def test_old_and_new_files_together(spark, frame, tmp_path, wide):
    root, dates = str(tmp_path), ["2025-01-01", "2025-02-01"]
    for i, day in enumerate(dates):
        kind = "bigint" if i == wide else "int"
        path = f"{S.BRONZE_POP_UF.location(root)}/data_carga={day}"
        frame([("x", 7)], f"unidade_federativa string, populacao {kind}").write.parquet(path)
    for df in (read_loads(spark, root, S.BRONZE_POP_UF, dates), read_table(spark, root, S.BRONZE_POP_UF)):
        assert df.schema["populacao"].dataType.simpleString() == "int"
        assert sorted(r["data_carga"] for r in df.where("populacao = 7").collect()) == dates


def test_only_numbers_wider_than_the_table_are_checked_row_by_row(spark, frame, tmp_path):
    """Checks in every column make plans of several layers too long to be compiled."""
    root, place = str(tmp_path), S.BRONZE_POP_UF.location(str(tmp_path))
    for day, kind, people in ((D1, "int", 7), (D2, "smallint", 8), (D3, "bigint", 1 << 31)):
        frame([("x", people)], f"unidade_federativa string, populacao {kind}").write.parquet(f"{place}/data_carga={day}")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString().lower()
    narrow = read_loads(spark, root, S.BRONZE_POP_UF, [D1, D2])
    assert "raise_error" not in plan(narrow)
    assert sorted(r["populacao"] for r in narrow.collect()) == [7, 8]
    wide = read_loads(spark, root, S.BRONZE_POP_UF, [D1, D3])
    assert "raise_error" in plan(wide) and "union" not in plan(wide)
    assert wide.where(F.col(LOAD_DATE) == D1).first()["populacao"] == 7
    assert "whole number" in fails(wide)


def test_files_without_a_column_are_an_error(spark, frame, tmp_path):
    path = f"{S.BRONZE_POP_UF.location(str(tmp_path))}/data_carga=2025-01-01"
    frame([("x",)], "unidade_federativa string").write.parquet(path)
    with pytest.raises(ValueError, match="populacao"):
        read_loads(spark, str(tmp_path), S.BRONZE_POP_UF, "2025-01-01")


@pytest.mark.parametrize("value, kind", [(70.9, "double"), (3e9, "double"), (3_000_000_000, "bigint")])
def test_nothing_is_cut_to_fit_a_whole_number(frame, value, kind):
    df = frame([("x", value, "2025-01-01")], f"unidade_federativa string, populacao {kind}, data_carga string")
    assert "whole number" in fails(S.BRONZE_POP_UF.conform(df))
    good = frame([("x", 70.0, "2025-01-01"), ("y", None, "2025-01-01")], "unidade_federativa string, populacao double, data_carga string")
    assert [r["populacao"] for r in S.BRONZE_POP_UF.conform(good).collect()] == [70, None]


@pytest.mark.parametrize("other", ["string", "boolean", "timestamp"])
def test_each_file_of_a_load_is_compared_with_the_table(spark, frame, tmp_path, other):
    """Two loads, two files in one of them; only one file is wrong."""
    root, place = str(tmp_path), S.BRONZE_POP_UF.location(str(tmp_path))
    ddl = "unidade_federativa string, populacao int"
    for day in (D1, D2):
        frame([("x", 7)], ddl).write.parquet(f"{place}/data_carga={day}")
    assert read_loads(spark, root, S.BRONZE_POP_UF, [D1, D2]).count() == 2
    frame([("y",)], "unidade_federativa string").write.mode("append").parquet(f"{place}/data_carga={D2}")
    wrong = {f.name for f in (tmp_path / S.BRONZE_POP_UF.folder / f"data_carga={D2}").glob("*.parquet")}
    for read in (lambda: read_loads(spark, root, S.BRONZE_POP_UF, [D1, D2]), lambda: read_table(spark, root, S.BRONZE_POP_UF)):
        with pytest.raises(ValueError, match="no column populacao") as problem:
            read()
        assert sum(name in str(problem.value) for name in wrong) == 1
    assert read_loads(spark, root, S.BRONZE_POP_UF, D1).count() == 1
    column = {"string": F.lit("7"), "boolean": F.lit(True), "timestamp": F.current_timestamp()}[other]
    frame([("y",)], "unidade_federativa string").withColumn("populacao", column).write.parquet(f"{place}/data_carga={D3}")
    with pytest.raises(ValueError, match=f"data_carga={D3}.*column populacao holds {other[:4]}"):
        read_loads(spark, root, S.BRONZE_POP_UF, [D1, D3])


def test_files_of_many_shapes_are_read_together(spark, frame, tmp_path):
    """Whole numbers under a price, a column of nulls, fractions, decimals, text codes."""
    folder = tmp_path / BRONZE_BASKET.folder / f"{LOAD_DATE}={D1}"
    folder.mkdir(parents=True)
    kinds = [pa.int8(), pa.uint16(), pa.int64(), pa.float32(), pa.float64(), pa.decimal128(22, 2), pa.null(), pa.uint64()]
    for i, kind in enumerate(kinds):
        value = [None if kind == pa.null() else 3]
        names = pa.array([f"c{i}"]).dictionary_encode() if i % 2 else pa.array([f"c{i}"], pa.large_string())
        pq.write_table(
            pa.table({"valor": pa.array(value, pa.int64()).cast(kind) if kind != pa.null() else pa.nulls(1),
                      "cidade": names, "data_mes": pa.nulls(1) if i == 2 else pa.array(["2025-01-01"])}),
            folder / f"f{i}.parquet",
        )
    got = read_loads(spark, str(tmp_path), BRONZE_BASKET, D1)
    assert got.schema == BRONZE_BASKET.struct
    want = {(None if i == 2 else "2025-01-01", f"c{i}", None if kinds[i] == pa.null() else 3.0, D1) for i in range(len(kinds))}
    assert {tuple(r) for r in got.collect()} == want


def test_footers_are_compared_by_content_where_only_spark_opens_a_store(spark, frame, tmp_path, monkeypatch):
    from umbu.sources import footers

    monkeypatch.setattr(footers, "_opens", lambda path: False)
    root = str(tmp_path)
    write_loads(prices(frame, D1), root, BRONZE_BASKET, D1)
    assert by_load(read_loads(spark, root, BRONZE_BASKET, D1)) == {D1: (3, 3.0)}
    frame([("y",)], "cidade string").write.parquet(load_path(root, BRONZE_BASKET, D2))
    with pytest.raises(ValueError, match="no column data_mes; no column valor"):
        read_loads(spark, root, BRONZE_BASKET, [D1, D2])


def test_outcomes_of_loads(spark, frame, tmp_path):
    assert {tuple(r) for r in load_outcomes(spark, str(tmp_path), BRONZE_BASKET, [D1]).collect()} == {(D1, False, 0)}
    write_loads(prices(frame, D1, D3), str(tmp_path), BRONZE_BASKET, [D1, D3])
    got = {r["load"]: r["found"] for r in load_outcomes(spark, str(tmp_path), BRONZE_BASKET, [D1, D2]).collect()}
    assert got == {D1: True, D2: False}
    assert load_outcomes(spark, str(tmp_path), BRONZE_BASKET, []).count() == 0


def switched(spark, tmp_path, name):
    lake = Lake(spark, str(tmp_path), f"{name}_", switched=True)
    lake.create_catalog()
    return lake


def test_a_write_that_breaks_in_the_middle_leaves_the_old_loads(spark, frame, tmp_path, monkeypatch):
    lake = switched(spark, tmp_path, "switch_broken")
    lake.save(prices(frame, D1, D2), BRONZE_BASKET, [D1, D2])
    old = {D1: (3, 3.0), D2: (3, 3.0)}
    assert by_load(lake.read(BRONZE_BASKET, [D1, D2])) == old
    # A task fails after another has written its files.
    stray = prices(frame, D1, valor=9.0).union(prices(frame, D3)).repartition(2, LOAD_DATE)
    with pytest.raises(Exception, match="not to be written"):
        lake.save(stray, BRONZE_BASKET, [D1])
    assert by_load(lake.read(BRONZE_BASKET, [D1, D2])) == old
    # All files are written, but the catalog is not reached.
    with monkeypatch.context() as broken:
        broken.setattr(catalog, "switch_loads", lambda *a: (_ for _ in ()).throw(OSError("no catalog")))
        with pytest.raises(OSError):
            lake.save(prices(frame, D1, D2, valor=5.0), BRONZE_BASKET, [D1, D2])
    assert by_load(lake.table(BRONZE_BASKET)) == old
    catalog.repair_table(spark, BRONZE_BASKET, lake.prefix)
    assert by_load(lake.table(BRONZE_BASKET)) == old
    lake.save(prices(frame, D1, D3, valor=5.0), BRONZE_BASKET, [D1, D3])
    assert by_load(lake.table(BRONZE_BASKET)) == {D1: (3, 15.0), D2: (3, 3.0), D3: (3, 15.0)}


def test_a_switched_lake(spark, frame, tmp_path):
    lake = switched(spark, tmp_path, "switch_lake")
    nothing = prices(frame, D1).limit(0)
    lake.save(prices(frame, D1), BRONZE_BASKET, D1)
    assert lake.save(nothing, BRONZE_BASKET, D1).loads == ()
    assert by_load(lake.read(BRONZE_BASKET, D1)) == {D1: (3, 3.0)}
    assert lake.save(nothing, BRONZE_BASKET, D1, keep_empty=True).loads == (D1,)
    assert lake.read(BRONZE_BASKET, D1).isEmpty() and lake.held(BRONZE_BASKET) == {D1}
    with pytest.raises(FileNotFoundError, match=D2):
        lake.read(BRONZE_BASKET, [D1, D2])
    with pytest.raises(ValueError):
        Lake(spark, str(tmp_path), registered=False, switched=True)


def test_databases(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), "dbs_")
    assert catalog.databases(spark, lake.prefix) == []
    lake.create_catalog()
    found = catalog.databases(spark, lake.prefix)
    assert [(layer, tables) for layer, _, tables in found] == [("bronze", 4), ("silver", 2), ("gold", 2)]
    assert all(place.endswith(f"{tmp_path}/{layer}") for layer, place, _ in found)
