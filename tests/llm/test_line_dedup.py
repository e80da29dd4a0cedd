from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tests.llm.samples import documents, empty, frame_of
from umbu.llm import line_dedup
from umbu.llm.line_dedup import dedup_lines, op7_line_dedup


def brute_force(rows, threshold=Fraction(4, 5)):
    """Each line against every earlier one."""
    lower = lambda s: s.encode().lower().split()
    lines = {}
    for doc_id, text, *_ in rows:
        for number, line in enumerate((text or "").split("\n")):
            if lower(line):
                order = (doc_id is None, doc_id or 0, number)
                lines[(doc_id, text, number)] = (order, frozenset(lower(line)))
    gone = set()
    for key, (order, words) in lines.items():
        for other, (before, theirs) in lines.items():
            if before < order and len(words & theirs) >= threshold * len(words | theirs):
                gone.add(key)
                break
    out = []
    for doc_id, text, *_ in rows:
        if text is None:
            out.append((doc_id, 0, None))
            continue
        parts = text.split("\n")
        left = [p for i, p in enumerate(parts) if (doc_id, text, i) not in gone]
        out.append((doc_id, len(parts) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def found(df):
    return sorted(
        (tuple(r) for r in df.select("doc_id", "n_removed_", "text").collect()), key=repr
    )


def test_equals_brute_force(spark):
    for seed in (1, 2):
        # Without ids the order of two rows is that of their hashes; one is enough here.
        rows = [r for r in documents(seed) if r[0] is not None or r[1] == documents(seed)[0][1]]
        assert found(dedup_lines(frame_of(spark, rows), counts=True)) == brute_force(rows)


def test_many_variants_of_a_line(spark, monkeypatch):
    """A dense group, with its lists in cells."""
    monkeypatch.setattr(line_dedup, "CELL_LINES", 40)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(200):
        words = base.copy()
        words[i % 40] = f"v{i}"
        rows.append((i, " ".join(words), None, None, None, None, None, None))
    rows.append((1000, " ".join(base[:28] + ["q"] * 3), None, None, None, None, None, None))
    df = dedup_lines(frame_of(spark, rows), counts=True)
    assert found(df) == brute_force(rows)


def test_keeps_columns_and_rows(spark):
    rows = documents(3)
    df = dedup_lines(frame_of(spark, rows))
    assert df.schema == frame_of(spark, rows).schema
    assert df.count() == len(rows)
    changed = {r["doc_id"] for r in dedup_lines(frame_of(spark, rows), counts=True).collect() if r["n_removed_"]}
    assert all(r["n_chars"] == len(r["text"]) for r in df.collect() if r["doc_id"] is not None and r["doc_id"] in changed)
    assert dedup_lines(empty(spark)).count() == 0


def test_query_against_brute_force(spark, tmp_path):
    rows = documents(4)
    rows = [r for r in rows if r[0] is not None]
    frame_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    df = op7_line_dedup(spark, str(tmp_path))
    got = sorted((tuple(r) for r in df.select("doc_id", "n_removed", "text").collect()), key=repr)
    assert got == brute_force(rows)
    assert df.where(F.col("n_removed") > 0).count() > 0


def test_a_text_of_very_many_lines(spark):
    """20,000 lines, many of them like others: as many again, not with their square."""
    import time

    lines = [f"line {i % 9000} of number {i % 9000} and {i % 9000 * 7}" for i in range(20_000)]
    rows = [(1, "\n".join(lines), "en", "a", 0, None, None, None), (2, lines[5] + "\nother", "en", "a", 0, None, None, None)]
    start = time.time()
    got = {r["doc_id"]: r for r in dedup_lines(frame_of(spark, rows), counts=True).collect()}
    assert got[1]["n_removed_"] == 11_000 and got[1]["text"] == "\n".join(lines[:9000])
    assert got[2]["text"] == "other" and got[1]["n_chars"] == len(got[1]["text"])
    assert time.time() - start < 120


def test_doubtful_lines_in_cells(spark, monkeypatch):
    """Bitmaps that tell nothing: first candidates fail, the second pass goes by cells."""
    monkeypatch.setattr(line_dedup, "CELL_LINES", 15)
    r = __import__("random").Random(5)
    base = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(150):
        words = r.sample(base, 24) + [f"x{r.randrange(6)}"]
        rows.append((i, " ".join(words), None, None, None, None, None, None))
    assert found(dedup_lines(frame_of(spark, rows), counts=True)) == brute_force(rows)
    assert found(dedup_lines(frame_of(spark, rows), Fraction(1, 2), counts=True)) == brute_force(rows, Fraction(1, 2))


def test_names_that_clash(spark):
    docs = frame_of(spark, documents(6)).withColumnsRenamed({"fp": "_gone", "root": "_left", "token": "removed"})
    assert dedup_lines(docs).schema == docs.schema
    assert dedup_lines(docs).count() == docs.count()


def test_order_of_postings_is_by_line():
    """Lists come in no order of their own; ties, null ids and wide ranges hold."""
    r = np.random.default_rng(7)
    for high in (50, 1 << 40, (1 << 63) - 1):
        group = np.sort(r.integers(0, 40, 3000))
        group = np.cumsum(np.append(False, np.diff(group) != 0))
        doc, line = r.integers(0, high, 3000), r.integers(0, 9, 3000).astype(np.int32)
        doc[:5] = line_dedup._NO_ID
        doc[5:8] = -(1 << 62)
        n = r.permutation(3000)
        rows = [*zip(group.tolist(), doc.tolist(), line.tolist(), n.tolist())]
        assert [rows[i] for i in line_dedup._by_line(group, doc, line, n)] == sorted(rows)
        alone = np.arange(3000)
        assert line_dedup._by_line(alone, doc % 1000, line, n).tolist() == alone.tolist()


def test_postings_are_sorted_by_one_number(spark, monkeypatch):
    """Spark then sorts by the digits, not by comparing rows."""
    plans, keep = [], line_dedup.keep

    def kept(df, purpose):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df, purpose)

    monkeypatch.setattr(line_dedup, "keep", kept)
    line_dedup.repeated_lines(frame_of(spark, documents(2)))
    sorts = [line for plan in plans for line in plan.splitlines() if "Sort [key" in line]
    assert sorts and not any("," in line.split("[")[1].split("]")[0] for line in sorts)


def sets_batch(r, rows, cells):
    """Sets of random bitmaps close to each other, with words of few kinds."""
    tokens = [sorted(r.choice(60, r.integers(1, 9), replace=False)) for _ in range(rows)]
    most = {t: cells if t % 5 == 0 else 1 for t in range(60)}
    bits = r.integers(0, 4, (2, rows))
    return pa.RecordBatch.from_pydict({
        "n": pa.array(r.permutation(rows)), "bits": pa.array(bits[0]), "more_bits": pa.array(bits[1]),
        "size": pa.array((r.integers(10, 40, rows)).astype(np.int32)),
        "doc": pa.array(r.integers(0, rows, rows)), "line": pa.array(r.integers(0, 3, rows).astype(np.int32)),
        "skip": pa.array(r.integers(0, 2, rows).astype(np.int32)),
        "tokens": pa.array([[int(t) | most[t] << 32 for t in x] for x in tokens], pa.list_(pa.int64())),
        "n_postings": pa.array([sum(2 * most[t] - 1 for t in x) for x in tokens], pa.int64()),
    })


def earliest_by_pairs(sets, num=4, den=5):
    """(a_n, b_n): of each set and word the earliest set that passes all filters."""
    lists, best = {}, set()
    for row in sets.to_pylist():
        for at, word in enumerate(row["tokens"]):
            lists.setdefault(word, []).append({**row, "left": row["size"] - row["skip"] - at})
    order = lambda x: (x["doc"], x["line"], x["n"])
    for members in lists.values():
        for b in members:
            passed = []
            for a in members:
                both = a["size"] + b["size"]
                shared = -(-num * both // (num + den))
                apart = (a["bits"] ^ b["bits"]).bit_count() + (a["more_bits"] ^ b["more_bits"]).bit_count()
                sizes = a["size"] * den >= b["size"] * num and b["size"] * den >= a["size"] * num
                if order(a) < order(b) and sizes and min(a["left"], b["left"]) >= shared and apart <= both - 2 * shared:
                    passed.append(a)
            if passed:
                best.add((min(passed, key=order)["n"], b["n"]))
    return best


def test_bundles_hold_every_posting_and_yield_the_earliest(monkeypatch):
    """Few rows travel, not one for each posting; lists by size lose no candidate."""
    r = np.random.default_rng(11)
    for cells, bundle in ((1, 1 << 18), (1, 100), (4, 300)):
        monkeypatch.setattr(line_dedup, "BUNDLE_POSTINGS", bundle)
        sets, parts = sets_batch(r, 600, cells), 7
        rows = pa.Table.from_batches([*line_dedup._bundles(parts)(iter([sets.slice(0, 250), sets.slice(250)]))])
        total = sum(sets["n_postings"].to_pylist())
        assert sum(len(x) for x in rows["n"].to_pylist()) == 8 * total
        assert rows.num_rows <= parts * (2 + 2 * total // bundle) and {*rows["key"].to_pylist()} == {*range(parts)}
        found = {}
        for key in range(parts):
            part = line_dedup._earliest(Fraction(4, 5))(rows.filter(pc.equal(rows["key"], key)))
            for a_doc, a_line, a_n, b_n in zip(*(part[c].to_pylist() for c in ("a_doc", "a_line", "a_n", "b_n"))):
                found.setdefault(b_n, []).append((a_doc, a_line, a_n))
        expected = {}
        for a_n, b_n in earliest_by_pairs(sets):
            i = sets["n"].to_pylist().index(a_n)
            expected.setdefault(b_n, []).append((sets["doc"][i].as_py(), sets["line"][i].as_py(), a_n))
        assert expected and {b: min(a) for b, a in found.items()} == {b: min(a) for b, a in expected.items()}


def test_postings_are_sent_in_few_rows(spark, monkeypatch):
    """Counts of words and postings were a row each: 6.9 and 20.3 million on 0.5 GB."""
    words = pa.array([" ".join(f"w{i}" for i in range(50_000))])
    [counted] = line_dedup._count(iter([pa.RecordBatch.from_arrays([words], names=["text"])]))
    assert counted.num_rows <= (1 << line_dedup.COUNT_BITS) // 16
    assert sum(sum(counted.column(i).to_pylist()) for i in range(1, 17)) == 50_000
    plans, keep = [], line_dedup.keep
    monkeypatch.setattr(line_dedup, "keep", lambda df, purpose: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df, purpose))
    line_dedup.repeated_lines(frame_of(spark, documents(2)))
    [pairs] = [plan for plan in plans if "Sort [key" in plan]
    assert "Generate" not in pairs.split("Sort [key")[1]


def test_bytes_are_mapped_as_by_a_table():
    from umbu.llm.words import LETTERS, LOWER, mapped

    data = np.random.default_rng(2).integers(0, 256, 3000).astype(np.uint8)
    for values in (LOWER, LETTERS):
        for some in (data, data[5:5], data[::1][7:]):
            got = mapped(some, values)
            assert got.dtype == values.dtype and (got == values[some]).all() and len(got) == len(some)
