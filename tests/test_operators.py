import pytest
from pyspark.sql import functions as F

from umbu.operators.columns import (
    all_but,
    clean_name,
    clean_names,
    drop,
    rename,
    with_load_dates,
)
from umbu.operators import joins
from umbu.operators.joins import fits_broadcast, join_dimension
from umbu.operators.lookups import (
    assigned_state,
    city_dimension,
    fill_uf,
    folded_states,
    state_dimension,
    with_state_name,
    with_uf_code,
)
from umbu.operators.rows import drop_missing, group_known, unpivot


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_names(frame):
    assert clean_name(" Rent Amount-Total ") == "rent_amount_total"
    assert clean_name(" Porto-Alegre X", hyphen=False) == "porto-alegre_x"
    df = frame([(1, 2, 3)], "a int, b int, c int").toDF("A b", "C-d", "e")
    assert clean_names(df).columns == ["a_b", "c_d", "e"]
    assert rename(df, {"e": "f", "absent": "g"}).columns == ["A b", "C-d", "f"]
    assert drop(df, ["e", "absent"]).columns == ["A b", "C-d"]
    assert all_but(df, "e") == ["A b", "C-d"]


def test_load_dates(frame):
    df = frame([(1,), (2,)], "a int")
    assert rows(with_load_dates(df, "2025-05-01")) == [(1, "2025-05-01"), (2, "2025-05-01")]
    many = with_load_dates(df, ["2025-05-01", "2025-06-01"])
    assert rows(many) == [(a, d) for a in (1, 2) for d in ("2025-05-01", "2025-06-01")]
    with pytest.raises(ValueError):
        with_load_dates(df, "yesterday")


def test_drop_missing_and_group_known(frame):
    df = frame(
        [("a", 1.0), ("a", None), (None, 2.0), ("b", float("nan"))], "k string, x double"
    )
    assert rows(drop_missing(df, ["k", "x"])) == [("a", 1.0)]
    assert rows(group_known(df, ["k"], F.count(F.lit(1)).alias("n"))) == [("a", 2), ("b", 1)]


def test_unpivot_keeps_nulls(frame):
    df = frame([("m1", "1.5", None), ("m2", None, "2")], "data_mes string, a string, `b-c` string")
    long = unpivot(df, ["data_mes"], "cidade", "valor")
    assert rows(long, "data_mes", "cidade") == [
        ("m1", "a", 1.5), ("m1", "b-c", None), ("m2", "a", None), ("m2", "b-c", 2.0),
    ]
    assert "Exchange" not in plan(long)


def test_dimensions(spark):
    assert state_dimension(spark).count() == 20
    assert city_dimension(spark).count() == 27
    assert ("rio de janeiro",) in rows(folded_states(spark).select("city"))
    assert city_dimension(spark).where("city_code IS NULL").count() == 7
    assert "LocalTableScan" in plan(folded_states(spark))


def test_lookups(frame):
    df = frame([("RJ",), ("SP",), (None,)], "uf string")
    found = {r["uf"]: (r["city_code"], r["estado"]) for r in with_uf_code(df).collect()}
    assert found == {"RJ": (330, "Rio de Janeiro"), "SP": (None, None), None: (None, None)}
    codes = frame([(330,), (999,)], "city_codigo int")
    assert rows(with_state_name(codes)) == [(330, "Rio de Janeiro"), (999, None)]
    towns = frame(
        [("natal", None), ("natal", "ZZ"), ("xyz", None), ("sao_luis", None), ("são_luís", None)],
        "cidade_cesta string, uf string",
    )
    assert rows(fill_uf(towns)) == [
        ("natal", "RN"), ("natal", "ZZ"), ("sao_luis", None), ("são_luís", "MA"), ("xyz", None),
    ]


def test_assigned_state_is_a_function_of_the_key(spark):
    ids = spark.range(20000).select("id", assigned_state([F.col("id")], 3).alias("code"))
    once = dict(ids.collect())
    assert dict(ids.repartition(7).collect()) == once
    assert len(set(once.values())) == 20
    other = dict(spark.range(20000).select("id", assigned_state([F.col("id")], 4)).collect())
    assert other != once


def test_fits_broadcast(frame):
    df = frame([("abc", 1), (None, 2)], "s string, n int")
    assert fits_broadcast(df)
    assert not fits_broadcast(df, rows=1)
    assert not fits_broadcast(df, size=4)
    assert fits_broadcast(df, rows=2, size=5)
    assert fits_broadcast(df.limit(0))


JOIN_CASES = ("inner", "left")


@pytest.mark.parametrize("how", JOIN_CASES)
@pytest.mark.parametrize("fits", [None, False])
def test_join_fans_out_and_keeps_misses(frame, how, fits):
    facts = frame([("x", 1), ("y", 2), (None, 3)], "k string, a int")
    names = frame([("x", 10), ("x", 11), ("z", 12), (None, 13)], "k string, b int")
    joined = join_dimension(facts, names, "k", how, fits)
    expected = [("x", 1, 10), ("x", 1, 11)]
    if how == "left":
        expected += [("y", 2, None), (None, 3, None)]
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(expected, key=str)


def test_join_broadcasts_only_within_the_bound(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(1000).withColumn("k", F.col("id") % 10)
        names = spark.range(10).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in plan(join_dimension(facts, names, "k"))
        assert "BroadcastHashJoin" not in plan(join_dimension(facts, names, "k", fits=False))
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 5)
        assert "BroadcastHashJoin" not in plan(join_dimension(facts, names, "k"))
        assert "BroadcastHashJoin" in plan(join_dimension(facts, names.limit(3), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        join_dimension(facts, names, "k", "full")


@pytest.mark.parametrize("how", JOIN_CASES)
def test_hot_key_is_split(spark, how):
    """Half of the facts share one key: its partition is read in several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        key = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 500)
        facts = spark.range(0, 200000, 1, 8).withColumn("k", key)
        names = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
        joined = join_dimension(facts, names, "k", how, fits=False)
        assert len(joined.collect()) == 200000
        assert "skew=true" in plan(joined)
        assert joined.where("v <> k * 3 OR v IS NULL").isEmpty()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
