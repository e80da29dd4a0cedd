import numpy as np
import pytest

from tests.conftest import SF_DIR
from umbu.llm import neighbours


def brute_force(rows, results=5):
    good = {}
    for vec_id, v, *_ in rows:
        if vec_id is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good.setdefault(vec_id, []).append(np.array(v, dtype=np.float32).astype(np.float64))
    ids = [i for i, vs in good.items() for _ in vs]
    x = np.array([v for vs in good.values() for v in vs])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in sorted(i for i in good if i % 50 == 0):
        sims = x @ x[ids.index(q)]
        order = sorted((-s, i) for s, i in zip(sims.round(12), ids) if i != q)
        out[q] = [(i, -s) for s, i in order[:results]]
    return out


def compare(df, want):
    """Shares of the true neighbours that were found; scores and ranks must hold."""
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    assert set(got) == {q for q, found in want.items() if found}
    for q, rows in got.items():
        assert [r for r, _, _ in rows] == list(range(1, len(want[q]) + 1))
        hits += len({i for _, i, _ in rows} & {i for i, _ in want[q]})
        known = dict(want[q])
        assert all(abs(s - known[i]) < 1e-9 for _, i, s in rows if i in known)
    return hits / max(1, sum(map(len, want.values())))


def test_recall_of_the_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert compare(neighbours.op5_nn_descent(spark, SF_DIR), brute_force(rows)) >= 0.9


def test_graph_of_many_leaves(spark, tmp_path, monkeypatch):
    """Odd vectors, copies and ties, with leaves so small that rounds must find the rest."""
    for name, value in (("LEAF", 100), ("PART_NODES", 300), ("QUERY_BLOCK", 7), ("SAMPLE", 256)):
        monkeypatch.setattr(neighbours, name, value)
    random = np.random.default_rng(2)
    rows = [(i, random.normal(size=16).astype(np.float32).tolist(), "a", 1.0) for i in range(1500)]
    rows += [(2000 + i, rows[7][1], "b", 1.0) for i in range(300)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    rows += [(3000 + 50 * i, v, None, None) for i, v in enumerate(odd)]
    rows += [(None, rows[3][1], "c", 1.0), rows[50]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, near string, score double")
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    want = brute_force(rows)
    assert 2000 in want and 3000 not in want
    assert compare(neighbours.op5_nn_descent(spark, str(tmp_path)), want) >= 0.9


def test_rounds_send_less_and_less(spark, monkeypatch, caplog):
    """Only fresh entries are compared: when lists settle, little is sent."""
    for name, value in (("LEAF", 100), ("PART_NODES", 300), ("SAMPLE", 256)):
        monkeypatch.setattr(neighbours, name, value)
    random = np.random.default_rng(4)
    rows = [(i, random.normal(size=16).astype(np.float32).tolist()) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    with caplog.at_level("INFO", logger=neighbours.__name__):
        graph = neighbours.build_graph(neighbours.prepare(df, 5)).collect()
    sent = [r.args[1] for r in caplog.records if r.name == neighbours.__name__]
    new = [r.args[2] for r in caplog.records if r.name == neighbours.__name__]
    assert len(sent) > 1 and sent[-1] < sent[0] / 10 and new[-1] <= neighbours.SETTLED * 2000 * neighbours.NEIGHBOURS
    x = np.array([v for _, v in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for r in graph:
        near, sims = np.frombuffer(r["near"], np.int64), np.frombuffer(r["sims"], np.float64)
        assert len(set(near.tolist())) == len(near) == neighbours.NEIGHBOURS and r["node"] not in near
        assert (np.diff(sims) <= 0).all() and r["least"] == sims[-1]


def test_leaves_that_the_sample_cannot_divide(spark, monkeypatch):
    """Neighbours are found whatever the residue of their node."""
    for name, value in (("LEAF", 100), ("PART_NODES", 300), ("SAMPLE", 64)):
        monkeypatch.setattr(neighbours, name, value)
    random = np.random.default_rng(5)
    rows = [(i, random.normal(size=16).astype(np.float32).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = neighbours.search(df, df.where("vec_id % 50 = 0"), 5)
    assert compare(found, brute_force(rows)) >= 0.9


def test_near_and_scaled_copies(spark):
    """Thousands of vectors that half precision cannot tell apart, and multiples of one."""
    random = np.random.default_rng(6)
    centre = random.normal(size=64) / 8
    near = (centre + 0.0004 * random.normal(size=(2500, 64))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(near)]
    # Few enough bits for exact multiples.
    one = (random.integers(-99, 99, size=64) / 64).tolist()
    rows += [(5000 + (i * 37) % 400, [x * (i + 1) for x in one]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = neighbours.search(df, df.where("vec_id % 50 = 0"), 5).collect()
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got, hits, asked = {}, 0, 0
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    for q in ids[ids % 50 == 0].tolist():
        if q >= 5000:
            assert got[q] == [i for i in range(5000, 5006) if i != q][:5]
            continue
        sims = x @ x[ids == q][0]
        sims[ids == q] = -2
        hits += len({*got[q]} & {*ids[np.argsort(-sims)[:5]].tolist()})
        asked += 5
    assert hits / asked >= 0.9


def test_search_opens_all_of_a_pool(spark):
    """Nodes in a row, each of which knows the next one only."""
    angles = np.arange(20) / 20
    x = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    rows = []
    for i in range(20):
        near = np.arange(i + 1, min(i + 2, 20))
        rows.append((i, bytearray(x[i]), bytearray(near.astype(np.int64)), bytearray(x[near] @ x[i])))
    graph = spark.createDataFrame(rows, "node bigint, vec binary, near binary, sims binary")
    (pool,) = neighbours.greedy_search(graph, graph.where("node = 0")).collect()
    assert np.frombuffer(pool["near"], np.int64).tolist() == list(range(1, 20))


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few(spark, n):
    df = spark.createDataFrame([(50 * i, [1.0, float(i)]) for i in range(n)], "vec_id bigint, embedding array<float>")
    assert neighbours.search(df, df, 5).count() == n * (n - 1)
