from pyspark.sql import functions as F

from tests.compare import connect, differences
from tests.conftest import SF_DIR
from tests.llm.samples import documents, empty, frame_of
from umbu.llm import decontamination as d
from umbu.llm.tables import keep

ITEM = "item_id bigint, text string"


def test_equals_its_sql(spark):
    df = d.op10_benchmark_decontamination(spark, SF_DIR)
    assert differences(df, connect(SF_DIR), d.SQL) == []


def test_odd_rows_equal_the_sql(spark, tmp_path):
    """Nulls, no words, short items, repeated rows, clashing columns."""
    import duckdb

    rows = documents(1)
    long = rows[2][1].replace("\n", " ")
    items = [(1, long), (2, "naïve"), (3, None), (4, ""), (5, long + " end"), (2, "Straße"), (6, "no-such-word here")]
    docs = frame_of(spark, rows).withColumn("n_words", F.lit("x")).withColumn("items", F.lit(1))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, ITEM).write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert differences(d.op10_benchmark_decontamination(spark, str(tmp_path)), con, d.SQL) == []


def test_drops_only_contaminated(spark):
    docs = frame_of(spark, documents(1))
    items = spark.createDataFrame([(1, documents(1)[2][1])], ITEM)
    left = d.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    bad = d.contamination(docs, items).where("contaminated").count()
    assert bad and left.count() == docs.count() - bad
    nothing = spark.createDataFrame([], ITEM)
    assert d.drop_contaminated(docs, nothing).count() == docs.count()
    assert d.drop_contaminated(empty(spark), items).count() == 0


def test_blocks_of_items_and_slop(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(1, "a b c d e f g h i j k l m n o"), (2, "a b c d X e f g h i j k l m"), (3, "m l k j i h g f e d c b a")],
        "doc_id bigint, text string",
    )
    items = spark.createDataFrame(
        [(7, "a b c d e f g h i j k l m"), (8, "c d e f g h i j k l m n o"), (9, "zz")], ITEM
    )
    monkeypatch.setattr(d, "BLOCK_WORDS", 1)
    index = keep(d.build_index(docs), "test")
    found = {r["doc_id"]: r for r in d.search_index(index, items, slop=1).collect()}
    assert found[1]["items"] == ["7", "8"] and [tuple(s) for s in found[1]["spans"]] == [(0, 13), (2, 15)]
    assert found[2]["items"] == [] and found[2]["near_items"] == ["7"]
    assert found[3]["items"] == [] and found[3]["near_items"] == []
    assert {r["doc_id"]: r["n"] for r in d.search_index(index, items).withColumn("n", d.hit_words()).collect()} == {1: 15, 2: 0, 3: 0}


def brute_near(docs, items, slop, window=13):
    """Items of which a window stands near some place: each word at most slop off."""
    import re

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    out = {}
    for doc_id, text in docs:
        said, found, exact = words(text), set(), set()
        for item, passage in items:
            of = words(passage)
            size = min(window, len(of))
            for at in range(len(of) - size + 1 if size else 0):
                run = of[at : at + size]
                for s in range(-slop, len(said) + slop):
                    if all(w in said[max(0, s + k - slop) : max(0, s + k + slop + 1)] for k, w in enumerate(run)):
                        found.add(str(item))
                    if s >= 0 and said[s : s + size] == run:
                        exact.add(str(item))
        out[doc_id] = (sorted(exact), sorted(found - exact))
    return out


def test_proximity_matches_equal_brute_force(spark, monkeypatch):
    """Words left out, put in, swapped, at the ends of texts, and items over many blocks."""
    import random

    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choices(vocabulary, k=n))) for i, n in enumerate([13, 20, 40, 5, 1, 0, 30, 14])]
    docs = []
    for i in range(60):
        text = " ".join(r.choices(vocabulary, k=r.randint(0, 15))).split()
        passage = r.choice(items)[1].split()
        for _ in range(r.randint(0, 3)):
            if passage:
                at = r.randrange(len(passage))
                passage = r.choice([passage[:at] + passage[at + 1 :], passage[:at] + ["zz"] + passage[at:],
                                    passage[:at] + passage[at : at + 2][::-1] + passage[at + 2 :]])
        docs.append((i, " ".join(text[: len(text) // 2] + passage + text[len(text) // 2 :])))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    index = keep(d.build_index(frame), "near-test")
    benchmark = spark.createDataFrame(items, ITEM)
    for slop, block_words in ((1, d.BLOCK_WORDS), (2, 7)):
        monkeypatch.setattr(d, "BLOCK_WORDS", block_words)
        got = {x["doc_id"]: (x["items"], x["near_items"]) for x in d.search_index(index, benchmark, slop=slop).collect()}
        assert got == brute_near(docs, items, slop)
        assert any(near for _, near in got.values())


def test_an_item_larger_than_a_block(spark, monkeypatch):
    """Every window is in one part, and hits are the same as in one block."""
    docs = frame_of(spark, documents(1))
    items = spark.createDataFrame([(1, documents(1)[-4][1]), (2, documents(1)[2][1])], ITEM)
    index = keep(d.build_index(docs), "large-item")
    rows = lambda: sorted(
        map(str, d.search_index(index, items).withColumn("spans", d.hit_words()).collect())
    )
    whole = rows()
    sizes = []
    monkeypatch.setattr(d, "BLOCK_WORDS", 3000)
    real = d.windows_of
    monkeypatch.setattr(d, "windows_of", lambda block, window: sizes.append(sum(len(w) for _, w in block)) or real(block, window))
    assert rows() == whole and len(sizes) > 2 and max(sizes) <= 3000 + 2 * d.WINDOW
