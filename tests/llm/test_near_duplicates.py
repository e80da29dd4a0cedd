import numpy as np
import xxhash

from tests.llm.samples import documents, empty, frame_of
from umbu.llm.near_duplicates import (
    _blocks_for,
    _masks,
    drop_near_duplicates,
    fingerprint,
    fingerprint_groups,
    near_duplicates,
    op3_simhash_near_dedup,
)
from umbu.llm.tables import keep


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, distance=4):
    """Smallest member reachable, by comparing all pairs."""
    fps = sorted(fps)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in fps}


def test_fingerprints():
    for row in documents(1):
        signed = fingerprint((row[1] or "").encode())
        assert signed & (1 << 64) - 1 == slow_fingerprint(row[1])
    assert fingerprint(b"") == 0


def test_query_equals_brute_force(spark, tmp_path):
    rows = documents(2)
    frame_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    fps = [slow_fingerprint(r[1]) for r in rows]
    root = groups(set(fps))
    least = {}
    for row, fp in zip(rows, fps):
        if row[0] is not None:
            least[root[fp]] = min(row[0], least.get(root[fp], row[0]))
    want = sorted(((r[0], f"{fp:016x}", least.get(root[fp])) for r, fp in zip(rows, fps)), key=repr)
    got = op3_simhash_near_dedup(spark, str(tmp_path)).select("doc_id", "fingerprint", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_links_of_made_fingerprints(spark):
    """Chains, dense groups, and every way in which up to 4 bits can differ."""
    r = np.random.default_rng(5)
    fps = set()
    for _ in range(40):
        fp = int(r.integers(0, 1 << 63))
        fps.add(fp)
        for _ in range(30):
            for bit in r.choice(63, size=int(r.integers(1, 6)), replace=False):
                fp ^= 1 << int(bit)
            fps.add(fp)
    dense = int(r.integers(0, 1 << 63))
    fps |= {dense ^ 1 << i ^ 1 << j for i in range(20) for j in range(20)}
    df = keep(spark.createDataFrame([(f,) for f in fps], "fp bigint"), "test")
    got = {row["fp"]: row["root"] for row in fingerprint_groups(df).collect()}
    want = groups(fps)
    assert {f: got.get(f, f) for f in fps} == want


def test_blocks():
    for blocks in (6, 7, 8):
        masks = _masks(blocks, 4)
        r = np.random.default_rng(1)
        for _ in range(200):
            change = sum(1 << int(b) for b in r.choice(64, 4, replace=False))
            assert any(change & (m & (1 << 64) - 1) == 0 for m in masks)
    assert _blocks_for(1, 4) == 6 and _blocks_for(1 << 30, 4) > 6


def test_one_stays(spark):
    rows = documents(6)
    docs = frame_of(spark, rows)
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    found = near_duplicates(docs).collect()
    kept = left.collect()
    assert len(kept) == len({r["root"] for r in found})
    ids = {r["doc_id"] for r in kept if r["doc_id"] is not None}
    assert {r["component_id"] for r in found if r["component_id"] is not None} == ids


def test_empty(spark):
    assert near_duplicates(empty(spark)).count() == 0
    assert drop_near_duplicates(empty(spark)).count() == 0
