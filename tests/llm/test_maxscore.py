import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.compare import connect, differences
from tests.conftest import SF_DIR
from umbu.llm import maxscore

MOST = 10**38 - 1
DDL = "vec_id bigint, embedding array<double>, label int, row string, vec int, query int"


def made(kind, n=260, seed=1):
    r = random.Random(seed)
    number = {
        "dense": lambda: r.gauss(0, 0.2),
        "sparse": lambda: r.gauss(0, 0.5) if r.random() < 0.2 else 0.0,
        "few": lambda: r.choice([-0.5, 0.0, 0.25]),
        "negative": lambda: -abs(r.gauss(0, 0.2)) if r.random() < 0.5 else abs(r.gauss(0, 0.2)),
        "wide": lambda: r.choice([1e15, -3e16, 2.5, 1e300]),
        "positive": lambda: abs(r.gauss(0, 0.1)) + 0.01,
    }[kind]
    rows = [(i * 10, [number() for _ in range(12)]) for i in range(n)]
    rows += [(100, rows[3][1]), (100, rows[3][1]), (100, rows[5][1]), (None, rows[4][1]), (None, rows[4][1])]
    rows += [(7000, None), (7001, []), (7100, []), (7200, [0.0] * 12), (7003, [1.0, None]), (7300, [math.nan] * 12)]
    rows += [(7400, [math.inf, 1.0]), (7500, [0.3]), (7600, [0.1] * 20), (7700, [-0.0004] * 12)]
    return [(*x, 0, "x", 1, 2) for x in rows]


def brute(rows, k=10):
    held = []
    for vec_id, vector, *_ in rows:
        if vector is None or any(x is None or not math.isfinite(x * 1024) for x in vector):
            continue
        held.append((vec_id, [math.floor(1024 * x) for x in vector]))
    out = Counter()
    for q, (query_id, query) in enumerate(held):
        if query_id is None or query_id % 100:
            continue
        scored = [(max(-MOST, min(MOST, sum(a * b for a, b in zip(query, c)))), i) for j, (i, c) in enumerate(held) if j != q]
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        for rank, (score, vec_id) in enumerate(scored[:k], 1):
            out[query_id, rank, vec_id, max(-(2**63) + 1, min(2**63 - 1, score))] += 1
    return out


@pytest.mark.parametrize("kind", ["dense", "sparse", "few", "negative", "wide", "positive"])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(maxscore, "SEEDS", 30)
    monkeypatch.setattr(maxscore, "SEGMENT_ROWS", 40)
    monkeypatch.setattr(maxscore, "DENSE", 3)
    monkeypatch.setattr(maxscore, "BLOCK_QUERIES", 16)
    rows = made(kind)
    spark.createDataFrame(rows, DDL).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = maxscore.op13_maxscore_topk(spark, str(tmp_path))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_query_equals_its_sql(spark):
    assert differences(maxscore.op13_maxscore_topk(spark, SF_DIR), connect(SF_DIR), maxscore.SQL) == []


def test_few_candidates_and_empty(spark):
    frame = lambda rows: maxscore.keep(maxscore.whole_numbers(spark.createDataFrame(rows, DDL)), "few")
    some = frame([(i * 100, [0.1 * i, -0.2], 0, "x", 1, 2) for i in range(3)])
    assert sorted(r["rank"] for r in maxscore.search(some, some).collect()) == [1, 1, 1, 2, 2, 2]
    none = frame([])
    assert maxscore.search(none, none).count() == 0
    assert maxscore.search(some, none).count() == 0


@pytest.mark.parametrize("dense", [1, 10**9])
def test_all_that_reach_the_score_to_beat_are_found(monkeypatch, dense):
    """By essential lists held by place or searched, for scores to beat of any height."""
    monkeypatch.setattr(maxscore, "DENSE", dense)
    r = np.random.default_rng(3)
    numbers = np.floor(r.normal(0, 200, (500, 16)) * (r.random((500, 16)) < 0.3))
    numbers[:, 0] *= 40
    place, dimension = np.nonzero(numbers)
    held = numbers[place, dimension]
    term = 2 * dimension + (held < 0)
    order = np.argsort(term, kind="stable")
    terms, counts = np.unique(term, return_counts=True)
    segment = maxscore.Segment(
        {
            "rows": np.arange(500).tobytes(), "ids": list(range(500)), "terms": terms.astype(np.int32).tobytes(),
            "counts": counts.astype(np.int32).tobytes(), "places": place[order].astype(np.int32).tobytes(),
            "numbers": held[order].tobytes(),
        }
    )
    query = np.full(16, 10.0)
    scores = numbers @ query
    for beat in (None, -5.0, 1.0, float(np.sort(scores)[-10]), float(scores.max())):
        places, found = segment.search(query, beat)
        want = np.flatnonzero(scores >= (beat if beat is not None else -np.inf))
        assert sorted(places.tolist()) == want.tolist()
        assert found.tolist() == scores[places].tolist()
