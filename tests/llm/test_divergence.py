import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.compare import connect, differences
from tests.conftest import SF_DIR
from tests.llm.samples import DOCS, documents, empty, frame_of
from umbu.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=10, top=10):
    docs = [((r[2] or ""), (r[3] or ""), TERM.findall((r[1] or "").translate(LOW))) for r in rows]
    seen, lang_n, n = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        seen[lang].update(set(words))
        lang_n[lang].update(words)
        n[lang, source].update(words)
    out = set()
    for lang in {d[0] for d in docs}:
        kept = [t for t, k in seen[lang].items() if k >= min_docs]
        share = lambda c: {
            t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for t in kept
        }
        q = share(lang_n[lang])
        sources = sorted({s for la, s, _ in docs if la == lang})
        p = {s: share(n[lang, s]) for s in sources}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(items, 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, value, rank))
    return out


def made(seed=1):
    """Hot and small sources, one without terms, one language without kept terms."""
    rows = documents(seed, 150)
    rows = [(*r[:2], ("en", "de")[k % 3 == 0], r[3] if k % 4 else f"s{k % 7}", *r[4:]) for k, r in enumerate(rows)]
    rows += [(3000 + i, t, "xx", s, 0, None, None, None) for i, (t, s) in enumerate([("one two", "a"), ("", "b"), (None, None)])]
    rows += [(4000, "12 34", "en", "numbers", 0, None, None, None), (4001, "A\x00b zÉz éz", None, None, 0, None, None, None)]
    return rows


@pytest.mark.parametrize("block_terms", [divergence.BLOCK_TERMS, 16])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, block_terms):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block_terms)
    monkeypatch.setattr(divergence, "ENTRIES", 700)
    rows = made()
    frame_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = divergence.op11_source_divergence(spark, str(tmp_path)).collect()
    assert len(got) == len(set(got))
    want = brute(rows)
    assert {tuple(r) for r in got} == want and len({x[2] for x in want}) == 2


def test_query_equals_its_sql(spark):
    got = divergence.op11_source_divergence(spark, SF_DIR)
    assert differences(got, connect(SF_DIR), divergence.SQL) == []


def test_empty_and_a_single_row(spark):
    assert divergence.divergences(empty(spark)).count() == 0
    one = spark.createDataFrame([(1, "x " * 20, "en", "a", 0, None, None, None)], DOCS)
    assert divergence.divergences(one).count() == 0
    assert [tuple(r) for r in divergence.divergences(one, min_docs=1).collect()] == []


def test_gallop():
    r = random.Random(2)
    for small, large in [(0, 5), (5, 0), (1, 1), (3, 400), (200, 200), (400, 3), (50, 5000)]:
        for skew in (1, 50):
            a = np.array(sorted(r.sample(range(10_000), small)), dtype=np.int64) // skew
            b = np.unique(np.array(r.sample(range(10_000), large), dtype=np.int64) // (51 - skew))
            a = np.unique(a)
            assert divergence.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()


def test_shares_are_exact_where_products_are_not():
    n = np.array([0, 1, 10**11, 4 * 10**17], dtype=np.int64)
    for total in (3, 10**11 + 7, 9 * 10**17):
        assert divergence.shares(n[n + 2 <= total], total).tolist() == [
            1 + 10**9 * (int(k) + 2) // total for k in n if k + 2 <= total
        ]
