"""Tables built from small loads, with rows worked out by hand."""

import math

import pytest

from umbu.plans import bronze, gold, silver
from umbu.plans.runs import Lake
from umbu.schemas import (
    BRONZE_BASKET,
    BRONZE_POP_MUN,
    BRONZE_RENT,
    GOLD_BASKET,
    GOLD_RENT,
    SILVER_BASKET,
    SILVER_RENT,
)
from umbu.sources.loads import read_table, write_loads

D1, D2 = "2025-05-01", "2025-06-01"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def types(table):
    return [*table.columns, ("data_carga", "string")]


def make(frame, table, *data):
    return frame(list(data), table.struct)


def test_bronze_rent(frame):
    names = [n for n, _ in BRONZE_RENT.columns]
    raw = frame(
        [tuple(str(i) for i in range(14)), ("9", None, "10.0", *["NA"] * 11)],
        ", ".join(f"{n} string" for n in names),
    ).toDF(*[n.replace("_", " ").title() for n in names])
    df = bronze.bronze_rent(raw, D1)
    assert df.dtypes == types(BRONZE_RENT)
    assert rows(df) == [(0, "1", *range(2, 14), D1), (9, None, 10, *[None] * 11, D1)]


@pytest.mark.parametrize("cell", ["1e-20", "5.0000000000000000001e0", "1e25"])
def test_a_listing_with_a_fraction_fails_the_load(spark, frame, tmp_path, cell):
    names = [n for n, _ in BRONZE_RENT.columns]
    ddl = ", ".join(f"{n} string" for n in names)
    lake = Lake(spark, str(tmp_path), registered=False)
    good = frame([("1", "x", "1.5e1", *["2"] * 11)], ddl)
    assert lake.bronze_rent(good, D1).rows == 1
    with pytest.raises(Exception, match="no whole number"):
        lake.bronze_rent(frame([("1", "x", cell, *["2"] * 11)], ddl), D1)
    assert [r["area"] for r in lake.read(BRONZE_RENT, D1).collect()] == [15]


def test_bronze_basket(frame):
    wide = frame(
        [("2024-01-01", "700.25", None), ("2024-02-01 00:00:00", "1", "2")],
        "Data string, ` São Paulo` string, `Mogi-Mirim` string",
    )
    df = bronze.bronze_basket(wide, D1)
    assert df.dtypes == types(BRONZE_BASKET)
    assert rows(df) == [
        ("2024-01-01", "mogi-mirim", None, D1),
        ("2024-01-01", "são_paulo", 700.25, D1),
        ("2024-02-01", "mogi-mirim", 2.0, D1),
        ("2024-02-01", "são_paulo", 1.0, D1),
    ]


def test_bronze_population(frame):
    by_uf = frame([("Rondônia", "1.746.227(1)"), ("Acre", "-")], "a string, b string")
    assert rows(bronze.bronze_population_uf(by_uf, D1)) == [
        ("Acre", None, D1), ("Rondônia", 17462271, D1),
    ]
    by_mun = frame(
        [("RO", "11", "00015", "Alta Floresta", "21 558")],
        "uf string, cod_uf string, cod_municipio string, municipio string, populacao string",
    )
    df = bronze.bronze_population_mun(by_mun, [D1, D2])
    assert df.dtypes == types(BRONZE_POP_MUN)
    assert rows(df) == [("RO", 11, 15, "Alta Floresta", 21558, d) for d in (D1, D2)]


@pytest.fixture
def towns(frame):
    return make(
        frame, BRONZE_POP_MUN,
        ("RJ", 33, 1, "Rio de Janeiro", 100, D1),
        ("RJ", 33, 1, "Rio de Janeiro", 110, D2),
        ("SP", 35, 2, "SÃO PAULO", 200, D1),
        ("PA", 15, 3, "Belém", 30, D1),
        ("AL", 27, 4, "BELEM", 40, D1),
        (None, 13, 5, "Manaus", None, D1),
        ("AC", 12, 6, "Acre", 0, D1),
        ("RN", 24, 7, "Rio Grande do Norte", None, D1),
    )


@pytest.fixture
def basket(frame):
    return make(
        frame, BRONZE_BASKET,
        ("2025-01-01", "rio_de_janeiro", 700.25, D1),
        ("2025-02-01", "rio_de_janeiro", 700.75, D1),
        ("2025-01-01", "rio_de_janeiro", 1.0, D2),
        ("2025-01-01", "são_paulo", 800.0, D1),
        ("2025-01-01", "belém", 500.0, D1),
        ("2025-01-01", "manaus", 600.0, D1),
        ("2025-01-01", "natal", 400.0, D1),
        ("2025-01-01", "xyz", None, D1),
    )


def test_silver_basket(basket, towns):
    df = silver.silver_basket(basket, towns)
    assert df.dtypes == types(SILVER_BASKET)
    assert rows(df) == sorted(
        [
            (330, "rio_de_janeiro", "RJ", 700.25, 1, 100, "Rio de Janeiro", D1),
            (330, "rio_de_janeiro", "RJ", 700.75, 1, 100, "Rio de Janeiro", D1),
            (330, "rio_de_janeiro", "RJ", 1.0, 1, 110, "Rio de Janeiro", D2),
            (None, "são_paulo", "SP", 800.0, 2, 200, None, D1),
            (150, "belém", "PA", 500.0, 3, 30, "Pará", D1),
            (270, "belém", "AL", 500.0, 4, 40, "Alagoas", D1),
            (130, "manaus", "AM", 600.0, 5, None, "Amazonas", D1),
            (240, "natal", "RN", 400.0, None, None, "Rio Grande do Norte", D1),
            (None, "xyz", None, None, None, None, None, D1),
        ],
        key=str,
    )


def test_gold_basket(basket, towns):
    df = gold.gold_basket(silver.silver_basket(basket, towns))
    assert df.dtypes == types(GOLD_BASKET)
    assert rows(df) == sorted(
        [
            (330, "rio_de_janeiro", "Rio de Janeiro", 700.5, 200, 140100.0, D1),
            (330, "rio_de_janeiro", "Rio de Janeiro", 1.0, 110, 110.0, D2),
            (150, "belém", "Pará", 500.0, 30, 15000.0, D1),
            (270, "belém", "Alagoas", 500.0, 40, 20000.0, D1),
            (130, "manaus", "Amazonas", 600.0, 0, 0.0, D1),
            (240, "natal", "Rio Grande do Norte", 400.0, 0, 0.0, D1),
        ],
        key=str,
    )


def test_gold_basket_reads_text_columns(frame):
    ddl = ", ".join(f"{n} string" for n in SILVER_BASKET.struct.names)
    data = [
        ("330", "rio", "RJ", "x", "1", "5.0", "Rio", D1),
        ("?", "a", "b", "1", "1", "1", "c", D1),
    ]
    df = frame(data, ddl)
    assert rows(gold.gold_basket(df)) == [(330, "rio", "Rio", None, 5, None, D1)]


def listing(i, area=10, rooms=2, rent=100, total=125, date=D1):
    return (i, "any", area, rooms, 1, 0, 3, 1, 0, 9, rent, 5, 2, total, date)


def test_silver_rent(frame, towns):
    """With every state drawn, only those that are also towns are left."""
    rents = make(
        frame, BRONZE_RENT,
        *[listing(i) for i in range(2000)],
        *[listing(i, area=0, total=0) for i in range(2000, 4000)],
        *[listing(i, area=None) for i in range(4000, 4100)],
        *[listing(i, date="2025-07-01") for i in range(4100, 4200)],
    )
    df = silver.silver_rent(rents, towns)
    assert df.dtypes == types(SILVER_RENT)
    found = {}
    for r in df.collect():
        key = (r.city_codigo, r.city, r.area, r.total, r.populacao, r.data_carga)
        value = (repr(r.aluguel_m2), repr(r.aluguel_per_capita))
        assert found.setdefault(key, value) == value
    assert found == {
        (330, "rio de janeiro", 10, 125, 100, D1): ("12.5", "1.25"),
        (330, "rio de janeiro", 0, 0, 100, D1): ("nan", "0.0"),
        (120, "acre", 10, 125, 0, D1): ("12.5", "inf"),
        (120, "acre", 0, 0, 0, D1): ("nan", "nan"),
        (240, "rio grande do norte", 10, 125, None, D1): ("12.5", "None"),
        (240, "rio grande do norte", 0, 0, None, D1): ("nan", "None"),
    }
    assert 500 < df.count() < 700  # three states of twenty, of 4000 listings


def test_gold_rent(frame):
    def row(area, rooms, rent, total):
        return (area, rooms, 1, 1, 1, 1, 1, rent, total, 330, "rio", 1.0, 5, 1.0, D1)

    df = gold.gold_rent(
        make(frame, SILVER_RENT, row(10, 4, 25, 30), row(0, -2, 25, 30), row(None, None, None, 30))
    )
    assert df.dtypes == types(GOLD_RENT)
    assert rows(df) == sorted(
        [
            ("rio", 2.5, 55.0, 6.25, D1),
            ("rio", None, 55.0, None, D1),
            ("rio", None, None, None, D1),
        ],
        key=str,
    )


def test_many_loads_at_once_are_as_one_by_one(spark, frame, basket, towns, tmp_path):
    """Also: doing it all again changes nothing."""
    rents = make(frame, BRONZE_RENT, *[listing(i, date=d) for d in (D1, D2) for i in range(300)])
    lakes = []
    for name, runs in (("once", [[D1, D2]]), ("each", [D1, D2]), ("again", [[D1, D2], D2, D1])):
        lake = Lake(spark, str(tmp_path / name), f"test_{name}_")
        lake.create_catalog()
        write_loads(basket, lake.root, BRONZE_BASKET, [D1, D2])
        write_loads(towns, lake.root, BRONZE_POP_MUN, [D1, D2])
        write_loads(rents, lake.root, BRONZE_RENT, [D1, D2])
        for dates in runs:
            assert lake.silver_basket(dates).rows and lake.gold_basket(dates).rows
            assert lake.silver_rent(dates).rows and lake.gold_rent(dates).rows
        lakes.append(lake)
    for table in (SILVER_BASKET, GOLD_BASKET, SILVER_RENT, GOLD_RENT):
        results = [rows(read_table(spark, lake.root, table)) for lake in lakes]
        assert results[0] == results[1] == results[2] != []
        assert rows(lakes[0].table(table)) == results[0]


def test_bronze_runs(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), "test_bronze_runs_")
    lake.create_catalog()
    for name in ("basket", "rent"):
        (tmp_path / name).mkdir()
    (tmp_path / "basket" / "sheet.csv").write_text("Data,são_paulo,natal\n2024-01-01,1.5,\n")
    header = ",".join(n for n, _ in BRONZE_RENT.columns).replace("_", " ")
    (tmp_path / "rent" / "rent.csv").write_text(
        f"{header}\n{','.join(['1', 'x', *map(str, range(12))])}\n"
    )
    (tmp_path / "uf.csv").write_text("T\n\nUF,POP\nAcre,\"880.631(1)\"\n")
    (tmp_path / "mun.csv").write_text(
        "T\nUF,COD. UF,COD. MUNIC,NOME DO MUNICÍPIO,POPULAÇÃO ESTIMADA\nAC,12,13,Acrelândia,14.2\n"
    )
    assert lake.bronze_basket(str(tmp_path / "basket"), [D1, D2]).rows == 4
    assert lake.bronze_rent(str(tmp_path / "rent"), D1).rows == 1
    reports = lake.bronze_population(str(tmp_path / "uf.csv"), str(tmp_path / "mun.csv"), D1)
    assert [r.rows for r in reports] == [1, 1]
    assert rows(lake.table(BRONZE_BASKET)) == sorted(
        [
            ("2024-01-01", city, valor, day)
            for day in (D1, D2)
            for city, valor in (("são_paulo", 1.5), ("natal", None))
        ],
        key=str,
    )
    assert rows(lake.table(BRONZE_POP_MUN)) == [("AC", 12, 13, "Acrelândia", 142, D1)]


def test_empty_silver_rent_is_not_written(spark, frame, towns, tmp_path):
    lake = Lake(spark, str(tmp_path), registered=False)
    write_loads(make(frame, BRONZE_RENT, listing(1)), lake.root, BRONZE_RENT, D1)
    nowhere = make(frame, BRONZE_POP_MUN, ("XX", 1, 1, "Nowhere", 1, D1))
    write_loads(nowhere, lake.root, BRONZE_POP_MUN, D1)
    assert lake.silver_rent(D1).rows == 0
    with pytest.raises(FileNotFoundError):
        lake.gold_rent(D1)


def test_plans_stay_in_the_jvm_and_shuffle_once(basket, towns, frame):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    whole = plan(gold.gold_basket(silver.silver_basket(basket, towns)))
    assert whole.count("Exchange hashpartitioning") == 1
    assert whole.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in whole
    rent = plan(gold.gold_rent(silver.silver_rent(make(frame, BRONZE_RENT, listing(1)), towns)))
    assert "Exchange hashpartitioning" not in rent
    for text in (whole, rent):
        assert "Python" not in text.replace("PythonRDD", "")


def test_infinite_values_survive_a_write(spark, frame, tmp_path):
    df = make(frame, GOLD_RENT, ("a", math.inf, math.nan, None, D1))
    write_loads(df, str(tmp_path), GOLD_RENT, D1)
    row = read_table(spark, str(tmp_path), GOLD_RENT).first()
    assert row[1] == math.inf and math.isnan(row[2]) and row[3] is None
