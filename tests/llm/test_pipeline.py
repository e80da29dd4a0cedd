import random

import corpus_pipeline
from tests.conftest import SF_DIR
from tests.llm.samples import DOCS

ITEM = "item_id bigint, text string"


def made(spark, folder):
    """Clean prose in two languages, copies, near copies, contaminated and empty rows."""
    r = random.Random(4)
    syllables = {"en": "the and ing tion er st wh ly".split(), "de": "sch ung keit ver über ein ß tz".split()}
    word = lambda lang: "".join(r.choices(syllables[lang], k=r.randint(2, 4)))
    text = lambda lang, n=120: " ".join(word(lang) for _ in range(n))
    clean = {i: (("en", "de")[i % 2], text(("en", "de")[i % 2])) for i in range(40)}
    item = text("en", 30)
    rows = [(i, t, lang, f"s{i % 5}") for i, (lang, t) in clean.items()]
    rows += [(100 + i, clean[i][1], clean[i][0], "s1") for i in range(10)]
    near = clean[3][1].split()
    near[5] = "sch"
    rows += [(200, " ".join(near), "de", "s1"), (201, f"{text('en', 20)} {item}", "en", "s1")]
    rows += [(300, None, "en", "s1"), (301, "", "en", "s1"), (302, "12 !! 34", "en", "s1")]
    frame = spark.createDataFrame([(*row, 0, None, None, None) for row in rows], DOCS)
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], ITEM).write.parquet(f"{folder}/benchmark.parquet")
    return clean


def test_pipeline_equals_what_is_planted(spark, tmp_path):
    clean = made(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(clean)
    assert sum(r["n_words"] for r in packed) == sum(len(t.split()) for _, t in clean.values())


def test_pipeline_on_the_tables(spark):
    packed = corpus_pipeline.run(spark, SF_DIR)
    rows = packed.collect()
    assert rows and len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows)
    held = {}
    for r in rows:
        if r["bin"] is not None:
            held[r["bin"]] = held.get(r["bin"], 0) + r["n_words"]
    assert max(held.values()) <= 2048


def test_texts_that_lose_lines_are_split_once(spark):
    """Not a second time, by a second Python worker, to see whether anything is left."""
    docs = spark.createDataFrame([(i, f"a b c\nd e f {i}\n", "en", "s", 0, None, None, None) for i in range(9)], DOCS)
    left = corpus_pipeline.remove_repeated_lines(spark, docs, "")
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert left.where("text like '%a b c%'").count() == 1 and left.count() == 9
