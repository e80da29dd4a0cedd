from collections import defaultdict

from tests.llm.samples import documents, empty, frame_of
from umbu.llm import packing


def slow_best_fit(sizes, sources, clusters, capacity):
    """Try every bin for every piece."""
    bins, out = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        fits = [
            (capacity - sum(s for s, _, _ in b), i)
            for i, b in enumerate(bins)
            if capacity - sum(s for s, _, _ in b) >= size
            and all(source != x and cluster != y for _, x, y in b)
        ]
        number = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([])
        bins[number].append((size, source, cluster))
        out.append(number)
    return out


def test_best_fit_equals_brute_force():
    import random

    for seed in range(5):
        r = random.Random(seed)
        sizes = sorted((r.randint(1, 100) for _ in range(300)), reverse=True)
        sources = [0 if r.random() < 0.35 else r.randint(1, 12) for _ in sizes]
        clusters = [0 if r.random() < 0.3 else r.randint(1, 200) for _ in sizes]
        bins, slots, offsets = packing.best_fit(sizes, sources, clusters, 100)
        assert bins == slow_best_fit(sizes, sources, clusters, 100)
        held = defaultdict(int)
        for size, number, offset in zip(sizes, bins, offsets):
            assert offset == held[number]
            held[number] += size


def check(rows, docs_rows, capacity):
    """Every word once, nothing over capacity, no conflict."""
    squeezed = lambda t: " ".join((t or "").lower().split())
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"], r["text_hash"]].append(r)
        if r["bin"] is not None:
            bins[r["bin"]].append(r)
    words = lambda t: len((t or "").encode().split())
    assert sum(r["n_words"] for r in rows) == sum(words(d[1]) for d in docs_rows)
    of = {d[0]: d for d in docs_rows if d[0] is not None}
    for held in bins.values():
        held.sort(key=lambda r: r["slot"])
        assert sum(r["n_words"] for r in held) <= capacity
        assert [r["offset"] for r in held] == [sum(x["n_words"] for x in held[:i]) for i in range(len(held))]
        named = [of[r["doc_id"]] for r in held if r["doc_id"] is not None]
        sources = [d[3] for d in named if d[3] is not None]
        assert len(sources) == len(set(sources))
        assert len(named) == len({squeezed(d[1]) for d in named})


def test_pack(spark, monkeypatch):
    rows = documents(1)
    for group in (4096, 10):
        monkeypatch.setattr(packing, "GROUP_PIECES", group)
        found = packing.pack(frame_of(spark, rows), capacity=64).collect()
        check(found, rows, 64)
        assert sum(r["bin"] is None for r in found) == 3
    assert packing.pack(empty(spark)).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    """One group: the whole table is packed as the plain search packs it."""
    rows = [r for r in documents(2) if r[0] is not None]
    frame_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = packing.pack(spark.read.parquet(str(tmp_path / "documents.parquet"))).where("bin is not null").collect()
    got.sort(key=lambda r: (-r["n_words"], r["doc_id"], r["text_hash"], r["piece"]))
    of = {d[0]: d for d in rows}
    source = [of[r["doc_id"]][3] or r["doc_id"] for r in got]
    cluster = [" ".join(of[r["doc_id"]][1].lower().split()) for r in got]
    want = slow_best_fit([r["n_words"] for r in got], source, cluster, packing.CAPACITY)
    assert [r["bin"] for r in got] == want
    assert packing.op2_best_fit_packing(spark, str(tmp_path)).count() >= len(got)


def test_query_keeps_near_copies_apart(spark, tmp_path):
    """Texts of different sources that differ in a word or two of many."""
    import random

    from umbu.llm.near_duplicates import near_duplicates

    r = random.Random(3)
    vocabulary = [f"word{i}" for i in range(400)]
    rows = []
    for i in range(40):
        text = r.choices(vocabulary, k=300)
        for j in range(3):
            near = text.copy()
            near[-1] = f"end{j}"
            rows.append((10 * i + j, " ".join(near), "en", f"s{j}", 0, None, None, None))
    docs = frame_of(spark, rows + [rows[0], (None, rows[0][1], "en", "s9", 0, None, None, None)])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    group = {x["doc_id"]: x["root"] for x in near_duplicates(docs).collect()}
    near = [i for i in range(40) if group[10 * i] == group[10 * i + 1]]
    assert len(near) > 10
    got = packing.op2_best_fit_packing(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + 2 and sum(x["n_words"] for x in got) == 300 * len(got)
    held = defaultdict(list)
    for x in got:
        held[x["bin"]].append(group[x["doc_id"]])
    assert all(len(g) == len(set(g)) for g in held.values())
