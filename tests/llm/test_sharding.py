import random
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from tests.llm.samples import DOCS, documents, empty, frame_of
from umbu.llm import sharding


def size(text):
    return len((text or "").encode()) + 1


def crc(text):
    return zlib.crc32((text or "").encode())


def heavy_texts(rows, shards=8):
    """Texts whose copies together weigh more than the rule's limit."""
    weights = Counter()
    for r in rows:
        weights[crc(r[1])] += size(r[1])
    limit = sharding.HEAVY * sum(weights.values()) / shards
    return {c for c, w in weights.items() if w > limit}


def test_query_law(spark, tmp_path, monkeypatch):
    """Sizes, checksums and slots by brute force; sides of each split hold their bytes."""
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 7)
    monkeypatch.setattr(sharding, "HEAVY", 0.05)
    rows = [r for r in documents(1, 400) if r[0] != 503]  # a text larger than a shard
    rows += [(9000 + i, "copy of one text", "en", "hot", 1, None, None, None) for i in range(3000)]
    frame_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sharding.op4_kd_sharding(spark, str(tmp_path)).collect()
    want = Counter((r[0], size(r[1]), crc(r[1])) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r)
    assert set(shards) == set(range(8))
    sizes = {s: sum(r["size"] for r in held) for s, held in shards.items()}
    mean, largest = sum(sizes.values()) / 8, max(size(r[1]) for r in rows)
    assert all(abs(x - mean) <= 0.1 * mean + 2 * largest for x in sizes.values())
    for held in shards.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
    # Copies are together, but for texts over the limit, which may be divided.
    places = defaultdict(set)
    for r in got:
        places[r["text_crc32"]].add(r["shard"])
    divided = {c for c, p in places.items() if len(p) > 1}
    assert divided <= heavy_texts(rows) and crc("copy of one text") in divided
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def brute_tree(rows, count):
    """The same tree by plain loops over rows whose ids are all different."""
    code = lambda v: zlib.crc32((v or "").encode()) % (1 << 16)
    bits = lambda i: xxhash.xxh64(struct.pack("<q", i), seed=42).intdigest() % (1 << 31)
    texts = defaultdict(list)
    for doc_id, text, lang, source, *_ in rows:
        texts[text or ""].append((doc_id, code(source), code(lang)))
    items = [
        (doc_id, t, [len(t), min(c[1] for c in copies), min(c[2] for c in copies)])
        for t, copies in texts.items() for doc_id, *_ in copies
    ]
    span = lambda some, d: max(x[2][d] for x in some) - min(x[2][d] for x in some)
    whole = [span(items, d) for d in range(3)]
    weight = lambda some: sum(size(x[1]) for x in some)
    heavy = sharding.HEAVY * weight(items) / count
    out, at = {}, 0

    def go(some, k):
        nonlocal at
        if k == 1:
            out.update({x[0]: at for x in some})
            at += 1
            return
        widths = [span(some, d) / max(1, whole[d]) for d in range(3)]
        d = widths.index(max(widths))
        key = lambda x: (x[2][d], crc(x[1]))
        need, total = weight(some) * (k // 2) / k, 0
        for cut in sorted({key(x) for x in some}):
            here = [x for x in some if key(x) == cut]
            if total + weight(here) >= need:
                break
            total += weight(here)
        before, after = [x for x in some if key(x) < cut], [x for x in some if key(x) > cut]
        rest = need - total

        def halves(before, here, after, rest):
            if not before or not after:
                left = bool(after) or not before
            else:
                left = 2 * rest >= weight(here)
            return (before + here, after) if left else (before, here + after)

        left, right = halves(before, here, after, rest)
        if weight(here) > heavy and 0 < rest < weight(here) and len(here) > 1:
            here.sort(key=lambda x: bits(x[0]))
            total = 0
            for i, x in enumerate(here):
                if total + size(x[1]) >= rest:
                    break
                total += size(x[1])
            a, b = halves(here[:i], here[i : i + 1], here[i + 1 :], rest - total)
            left, right = before + a, b + after
        share = round(k * weight(left) / weight(some))
        kl = max(1, k - len(right), min(share, k - 1, len(left)))
        go(left, kl)
        go(right, k - kl)

    go(items, min(count, len(items)))
    return out


@pytest.mark.parametrize("ordered, buckets", [(sharding.ORDERED, sharding.BUCKETS), (5, 8)])
def test_shards_are_those_of_the_tree(spark, monkeypatch, ordered, buckets):
    monkeypatch.setattr(sharding, "ORDERED", ordered)
    monkeypatch.setattr(sharding, "BUCKETS", buckets)
    rows = [r for r in documents(4, 120) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    rows += [(7000 + i, "many copies of this", "en", f"s{i % 3}", 1, None, None, None) for i in range(400)]
    for count in (8, 3):
        got = {r["doc_id"]: r["shard"] for r in sharding.kd_shards(frame_of(spark, rows), shards=count).collect()}
        assert got == brute_tree(rows, count)


def brute_cut(weights, need):
    """The first value up to which at least ``need`` lies, and what lies before it."""
    total = 0
    for value in sorted(weights):
        if total + weights[value] >= need:
            return value, total, weights[value]
        total += weights[value]
    raise AssertionError


def test_weighted_median(spark, monkeypatch):
    r = random.Random(3)
    rows = [(1, r.randrange(10**9) if r.random() < 0.7 else 777, r.randint(1, 50), 1) for _ in range(2000)]
    weights = defaultdict(int)
    for _, value, weight, _ in rows:
        weights[value] += weight
    df = spark.createDataFrame(rows, "node int, key bigint, weight bigint, n bigint")
    for ordered in (sharding.ORDERED, 10):
        monkeypatch.setattr(sharding, "ORDERED", ordered)
        for share in (0.01, 0.5, 1.0):
            cut = sharding._Cut(min(weights), max(weights), share * sum(weights.values()), len(rows))
            sharding._search(df, {1: cut})
            assert (cut.lo, cut.before[0], cut.at[0]) == brute_cut(weights, share * sum(weights.values()))


def test_other_counts_and_empty(spark):
    docs = frame_of(spark, documents(2))
    for shards in (1, 3, 5):
        got = sharding.kd_shards(docs, shards=shards).collect()
        assert len(got) == docs.count() and {r["shard"] for r in got} == set(range(shards))
    total = sum(r["size"] for r in got)
    assert len({r["shard"] for r in sharding.kd_shards(docs, target_bytes=total // 4 + 1).collect()}) == 4
    assert sharding.kd_shards(empty(spark), shards=8).count() == 0
    assert sharding.with_slots(sharding.kd_shards(empty(spark), shards=8)).count() == 0


def test_no_shard_is_empty_while_rows_suffice(spark):
    """One text has nearly all bytes; rows that cannot be told apart; fewer rows than shards."""
    row = lambda i, text: (i, text, "en", "hot", 1, None, None, None)
    tables = [
        [row(i, f"w{i}") for i in range(20)] + [row(99, "x" * 90_000)],
        [row(1, "same")] * 40,
        [row(None, None)] * 9,
        [row(i, "same") for i in range(8)],
        [row(i, f"w{i}") for i in range(5)],
    ]
    for rows in tables:
        got = sharding.kd_shards(spark.createDataFrame(rows, DOCS).repartition(3), shards=8).collect()
        assert len(got) == len(rows)
        assert {r["shard"] for r in got} == set(range(min(8, len(rows))))


def test_repeated_rows_are_numbered_in_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 10)
    rows = spark.createDataFrame([(1, "same", "en", "hot", 1, None, None, None)] * 300, DOCS)
    got = sharding.with_slots(sharding.keep(sharding.kd_shards(rows, shards=2), "few")).collect()
    for shard in (0, 1):
        held = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert held == list(range(len(held))) and abs(len(held) - 150) <= 1


def test_no_python_runs_on_executors(spark):
    """The plan reads files and computes in the JVM alone."""
    df = sharding.kd_shards(frame_of(spark, documents(5)), shards=4)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
