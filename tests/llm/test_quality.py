import random
import zlib

import numpy as np
import pyarrow as pa

from tests.conftest import SF_DIR
from tests.llm.samples import documents, empty, frame_of
from umbu.llm import quality as q
from umbu.llm.words import pieces

LABEL = "doc_id bigint, quality int, toxic int, score double"


def test_query_on_held_out_rows(spark):
    """Scores every row, learns from no held-out label, and tells the labels apart."""
    rows = q.op8_quality_embeddings(spark, SF_DIR).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    known = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in known]) > 0.85


def test_scores_do_not_depend_on_the_batch():
    texts = [t for _, t, *_ in documents(1)] + ["a", "x y", "naïve 日本", "w " * 5000]
    model = q.Model(np.random.default_rng(1).normal(size=1 << q.BUCKET_BITS), 0.3)
    held = type("Held", (), {"value": model})
    together = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["i", "t"])
    joint = np.concatenate([np.array(b.column(1)) for b in q._scorer(held)(iter([together]))])
    for i, text in enumerate(texts):
        alone = pa.RecordBatch.from_arrays([pa.array([i]), pa.array([text], pa.string())], names=["i", "t"])
        assert abs(next(q._scorer(held)(iter([alone]))).column(1)[0].as_py() - joint[i]) < 1e-9


def test_features_by_brute_force():
    """Counts of words, pairs and n-grams of a small text."""
    for text in ("one two  two\nüber", "", "a", "  ab "):
        piece = next(pieces(pa.array([text, "next"])))
        buckets, texts = q._features(piece)
        words = text.split()
        grams = 0
        for n in q.NGRAMS:
            for w in words:
                grams += max(0, len(w) + 2 - n + 1)
        assert np.sum(texts == 0) == grams + len(words) + max(0, len(words) - 1)


def test_odd_rows(spark):
    docs = frame_of(spark, documents(1))
    r = random.Random(1)
    rows = [(r.choice([0, 3, 6, None, 99]), r.choice([0, 1, None, 5]), 0, 0.0) for _ in range(40)]
    model = q.train(docs, spark.createDataFrame(rows, LABEL), "quality", ~q.held_out())
    assert q.score(docs, model).count() == docs.count()
    none = q.train(docs, spark.createDataFrame([], LABEL), "quality", ~q.held_out())
    assert {r["score"] for r in q.score(docs, none).collect()} == {0.5}
    assert q.score(empty(spark), model).count() == 0


MASK = (1 << 64) - 1
ODD = 0x9E3779B97F4A7C15


def brute_mix(h):
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & MASK
    return h ^ (h >> 31)


def brute_hash(part):
    raw = sum((b + 1) * pow(ODD, i, 1 << 64) for i, b in enumerate(part))
    return (raw + len(part) * 0xD6E8FEB86659FD93) & MASK


def brute_score(text, model):
    """The mean weight of a text's features and the bias, by plain loops."""
    import re

    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    features = []
    for word in words:
        padded = f" {word} "
        features += [
            brute_mix((brute_hash(padded[i : i + n].encode()) + n) & MASK)
            for n in q.NGRAMS for i in range(len(padded) - n + 1)
        ]
        features.append(brute_mix((brute_hash(word.encode()) + 99) & MASK))
    whole = [brute_mix(brute_hash(w.encode())) for w in words]
    features += [brute_mix((a * ODD + b) & MASK) for a, b in zip(whole, whole[1:])]
    odds = model.bias + sum(model.weights[f >> (64 - q.BUCKET_BITS)] for f in features) / max(1, len(features))
    return 1 / (1 + np.exp(-odds))


def test_query_scores_by_brute_force(spark, tmp_path, monkeypatch):
    """The query on a small table: every score from the model it learned, text by text."""
    rows = [r for r in documents(3, 40) if r[0] != 503] + [(900, "naïve  日本\n\tx", "en", "a", 0, None, None, None)]
    frame_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(r[0], i % 2, 0, 0.0) for i, r in enumerate(rows)]
    spark.createDataFrame(labels, LABEL).write.parquet(str(tmp_path / "labels.parquet"))
    models, learn = [], q.fit
    monkeypatch.setattr(q, "fit", lambda sample: models.append((len(sample), learn(sample))) or models[-1][1])
    got = q.op8_quality_embeddings(spark, str(tmp_path)).collect()
    usable = {r[0] for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1}
    ((n, model),) = models
    assert n == len(usable)
    want = sorted((str(r[0]), round(float(brute_score(r[1], model)), 9)) for r in rows)
    assert sorted((str(r["doc_id"]), round(r["score"], 9)) for r in got) == want


def test_a_sampled_id_on_very_many_rows(spark, monkeypatch):
    """One row of it is learned from."""
    rows = [(1, f"text {i % 7}", "en", "a", 0, None, None, None) for i in range(500)] + [(2, "other", "en", "a", 0, None, None, None)]
    sizes, learn = [], q.fit
    monkeypatch.setattr(q, "fit", lambda sample: sizes.append(len(sample)) or learn(sample))
    labels = spark.createDataFrame([(1, 1, 0, 0.0), (2, 0, 0, 0.0)], LABEL)
    model = q.train(frame_of(spark, rows), labels, "quality", q.F.lit(True))
    assert sizes == [2]
    assert q.score(frame_of(spark, rows), model).count() == 501
