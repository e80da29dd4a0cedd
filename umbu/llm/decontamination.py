"""Benchmark decontamination with a distributed positional inverted index.

The index is written in segments of whole texts, as a search engine does: each
holds its terms in order, how often each occurs, and the places of every term.
Searching a segment takes, for every window of a benchmark item, the list of its
rarest term there, shifts it by the term's offset in the window, and intersects
it with the shifted lists of the next rarest terms until none is left or all
terms agree (an exact phrase). With a slop, a window matches near a place if each of
its terms stands at most that many words off its own place there, in the same text (a
proximity match).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.llm.tables import keep, only, table, text_hash
from umbu.llm.words import LETTERS, hashed, pieces, word_hashes, word_places

WINDOW = 13
# Proximity matches: so many words off.
SLOP = 2
# Windows of items go to the tasks in blocks of at most about so many words.
BLOCK_WORDS = 200_000

_SEGMENT = "doc_id array<bigint>, text_hash array<bigint>, n_words array<int>, terms binary, counts binary, places binary"
_FOUND = "doc_id bigint, text_hash bigint, n_words int, items array<string>, starts array<int>, ends array<int>, near_items array<string>"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, hashes = batch.column(0), batch.column(1)
        for piece in pieces(batch.column(2)):
            starts, ends = word_places(piece, LETTERS)
            words = word_hashes(piece, starts, ends)
            order = np.argsort(words, kind="stable").astype(np.int32)
            terms, firsts = np.unique(words[order], return_index=True)
            steps = np.diff(order, prepend=np.int32(0))
            steps[firsts] = order[firsts]
            counts = np.diff(np.append(firsts, len(order))).astype(np.int32)
            cuts = np.searchsorted(starts, piece.bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids.slice(piece.first, piece.last - piece.first).to_pylist()], pa.list_(pa.int64())),
                    pa.array([hashes.slice(piece.first, piece.last - piece.first).to_pylist()], pa.list_(pa.int64())),
                    pa.array([np.diff(cuts).astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([terms.tobytes()], pa.binary()),
                    pa.array([counts.tobytes()], pa.binary()),
                    pa.array([steps.astype(np.int32).tobytes()], pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_words", "terms", "counts", "places"],
            )


def build_index(docs: DataFrame) -> DataFrame:
    """Positional index of all words of all texts, one row per segment, unwritten.

    Built without a shuffle. Words are runs of 0-9, a-z and all characters beyond
    ASCII, A-Z lower-cased; terms are 64-bit hashes of words. A null text has no
    words. Null and repeated ids are kept as they are. Texts are never cut.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), text_hash(), "text")
    return rows.mapInArrow(_segments, _SEGMENT)


@dataclass
class Windows:
    """Windows of a block of items: term numbers (-1 past the end) and their item."""

    terms: np.ndarray
    table: np.ndarray
    sizes: np.ndarray
    items: list[str | None]


def windows_of(items: list[tuple[object, np.ndarray]], window: int = WINDOW) -> Windows:
    """All runs of ``window`` words of each item's word hashes; a shorter item is one run."""
    rows, sizes, names = [], [], []
    for item, found in items:
        size = min(window, len(found))
        if not size:
            continue
        n = len(found) - size + 1
        part = np.zeros((n, window), dtype=np.uint64)
        part[:, :size] = np.lib.stride_tricks.sliding_window_view(found, size)
        rows.append(part)
        sizes.append(np.full(n, size, dtype=np.int64))
        names += [None if item is None else str(item)] * n
    table_ = np.concatenate([*rows, np.zeros((0, window), dtype=np.uint64)])
    sizes = np.concatenate([*sizes, np.zeros(0, dtype=np.int64)])
    used = np.arange(window) < sizes[:, None]
    terms = np.unique(table_[used])
    place = np.where(used, np.searchsorted(terms, table_), -1)
    return Windows(terms, place, sizes, names)


def _search(found: dict, query: Windows, slop: int, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, texts and first places of the windows that occur in a segment.

    ``bounds`` says where the words of each text begin; no match spans two texts.
    """
    terms, counts = found["terms"], found["counts"]
    ends = np.cumsum(counts, dtype=np.int64)
    # Places of all terms in one ascending list: the term's number, then the place.
    steps = found["places"].astype(np.int64)
    heads = ends - counts
    total = np.cumsum(steps)
    base = total[heads] - steps[heads] if len(heads) else total
    places = total - np.repeat(base, counts)
    keys = (np.repeat(np.arange(len(terms), dtype=np.int64), counts) << 32) + places
    at = np.minimum(np.searchsorted(terms, query.terms), max(len(terms) - 1, 0))
    known = terms[at] == query.terms if len(terms) else np.zeros(len(query.terms), bool)
    often = np.where(known, counts[at] if len(terms) else 0, 0)
    used = query.table >= 0
    frequency = np.where(used, often[query.table], np.iinfo(np.int32).max)
    alive = np.flatnonzero((frequency > 0).all(axis=1))
    none = np.zeros(0, dtype=np.int64)
    if not len(alive):
        return none, none, none
    order = np.argsort(frequency[alive], axis=1, kind="stable")
    rank = lambda k: query.table[alive, order[:, k]]
    first = at[rank(0)]
    lengths = counts[first].astype(np.int64)
    window = np.repeat(np.arange(len(alive)), lengths)
    inner = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = places[np.repeat(heads[first], lengths) + inner]
    doc = np.searchsorted(bounds, place, side="right") - 1
    start = place - order[window, 0]
    # The rarest term itself may be off its place.
    shifts = 2 * slop + 1
    window, doc = np.repeat(window, shifts), np.repeat(doc, shifts)
    start = np.repeat(start, shifts) + np.tile(np.arange(-slop, slop + 1), len(start))
    for k in range(1, query.table.shape[1]):
        term = rank(k)
        test = term[window] >= 0
        want = start + order[window, k]
        low, high = np.maximum(want - slop, bounds[doc]), np.minimum(want + slop, bounds[doc + 1] - 1)
        list_ = at[term[window]] << 32
        near = np.searchsorted(keys, list_ + low)
        hit = keys[np.minimum(near, len(keys) - 1)]
        good = ~test | ((near < len(keys)) & (hit <= list_ + high) & (low <= high))
        window, start, doc = window[good], start[good], doc[good]
        if not len(window):
            return none, none, none
    return alive[window], doc, start


def _merge(start: np.ndarray, end: np.ndarray) -> tuple[list[int], list[int]]:
    """Runs that cover the same words as the given ones, apart and in order."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    fresh = np.append(True, start[1:] > end[:-1])
    last = np.append(np.flatnonzero(fresh)[1:] - 1, len(start) - 1)
    return start[fresh].tolist(), end[last].tolist()


def _searcher(query, slop: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = query.value
        for batch in batches:
            for row in batch.to_pylist():
                found = {
                    "terms": np.frombuffer(row["terms"], np.uint64),
                    "counts": np.frombuffer(row["counts"], np.int32),
                    "places": np.frombuffer(row["places"], np.int32),
                }
                n = len(row["doc_id"])
                bounds = np.append(0, np.cumsum(row["n_words"], dtype=np.int64))
                out = [([], [], [], []) for _ in range(n)]
                for near in (False, True) if slop else (False,):
                    window, doc, start = _search(found, block, slop if near else 0, bounds)
                    end = start + block.sizes[window]
                    order = np.argsort(doc, kind="stable")
                    for part in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1):
                        if not len(part):
                            continue
                        at = int(doc[part[0]])
                        names = sorted({block.items[w] for w in window[part]} - {None})
                        if near:
                            out[at] = (*out[at][:3], sorted({*names} - {*out[at][0]}))
                        else:
                            begins, stops = _merge(start[part] - bounds[at], end[part] - bounds[at])
                            out[at] = (names, begins, stops, [])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_id"], pa.int64()),
                        pa.array(row["text_hash"], pa.int64()),
                        pa.array(row["n_words"], pa.int32()),
                        pa.array([x[0] for x in out], pa.list_(pa.string())),
                        pa.array([x[1] for x in out], pa.list_(pa.int32())),
                        pa.array([x[2] for x in out], pa.list_(pa.int32())),
                        pa.array([x[3] for x in out], pa.list_(pa.string())),
                    ],
                    names=["doc_id", "text_hash", "n_words", "items", "starts", "ends", "near_items"],
                )

    return search


def _blocks(benchmark: DataFrame, window: int) -> Iterator[list[tuple[object, np.ndarray]]]:
    """Items' words in blocks of bounded size; the driver holds one block and one item.

    A longer item is cut into parts that share all but one word of a window, so that
    every window is in one part. At least one block comes, if need be an empty one.
    """
    block, held = [], 0
    for item, text in benchmark.select("item_id", "text").toLocalIterator():
        (words,) = hashed([text], LETTERS)
        for at in range(0, max(1, len(words) - window + 1), BLOCK_WORDS):
            part = words[at : at + BLOCK_WORDS + window - 1]
            if block and held + len(part) > BLOCK_WORDS + window:
                yield block
                block, held = [], 0
            block.append((item, part))
            held += len(part)
    yield block


def search_index(
    index: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0
) -> DataFrame:
    """Matches of benchmark windows per document: one row for each indexed text.

    Columns doc_id, text_hash, n_words, items (ids of items of which a window
    occurs), spans (runs of hit words: first, and last plus one; those of different
    blocks may overlap), and near_items
    (items of which windows occur only within ``slop`` words; empty at 0).

    An item without words, or with a null text, has no window. An item without
    an id hits words but is not named. A match lies within one text. Items of one id count once. An empty
    benchmark hits nothing; an empty index gives no rows. Repeated documents each
    have their row.
    """
    spark = index.sparkSession
    out, blocks = None, 0
    for block in _blocks(benchmark, window):
        query = spark.sparkContext.broadcast(windows_of(block, window))
        found = index.mapInArrow(_searcher(query, slop), _FOUND)
        out = found if out is None else out.unionByName(found)
        blocks += 1
    spans = F.arrays_zip(F.col("starts").alias("first"), F.col("ends").alias("end"))
    merged = (
        out.withColumn("spans", spans)
        .groupBy("doc_id", "text_hash", "n_words")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
            F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("near_items")))).alias("near"),
        )
    )
    copies = F.array_repeat(F.lit(0), (F.col("copies") / F.lit(blocks)).cast("int"))
    return merged.select(
        "doc_id",
        "text_hash",
        "n_words",
        "items",
        "spans",
        F.array_except("near", "items").alias("near_items"),
        F.explode(copies).alias("_"),
    ).drop("_")


def hit_words(spans: str = "spans"):
    """How many words the spans, in order of their start, cover."""
    step = lambda state, x: F.struct(
        (state["n"] + F.greatest(x["end"] - F.greatest(x["first"], state["to"]), F.lit(0))).alias("n"),
        F.greatest(state["to"], x["end"]).alias("to"),
    )
    begin = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    return F.aggregate(spans, begin, step)["n"].cast("bigint")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document: words, hit words, items, and whether a twentieth is hit.

    Only exact matches hit words; with a slop, near_items names further items. See
    ``search_index`` for nulls, repeats and empty tables.
    """
    found = search_index(keep(build_index(docs), "postings"), benchmark, window, slop)
    found = found.withColumn("n_hit", hit_words()).withColumn("n_words", F.col("n_words").cast("bigint"))
    bad = (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))
    return found.withColumn("contaminated", bad)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    Rows that are equal in id and text share one fate, null and repeated ids are told
    apart by the text, and null or empty texts stay. An empty benchmark drops nothing.
    """
    found = contamination(docs, benchmark)
    bad = found.where("contaminated").select("doc_id", "text_hash").distinct()
    return only(docs, keep(bad, "contaminated"), "left_anti")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact matches of 13 words, and items that match near a place only (``near_items``,
    joined by commas) with a slop of two words; see ``search_index`` for all cases."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=SLOP)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
        F.concat_ws(",", "near_items").alias("near_items"),
    )


SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
    array_to_string(w[k : k + least(13, len(w)) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM item WHERE len(w) > 0)),
place AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS k FROM doc),
hit AS (
  SELECT p.r, p.k, x.n, x.item_id
  FROM (SELECT r, k, n, array_to_string(w[k : k + n - 1], ' ') AS gram
        FROM place, (SELECT DISTINCT n FROM win) WHERE k + n - 1 <= len(w)) p
  JOIN win x ON x.gram = p.gram AND x.n = p.n),
word AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS k FROM hit) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r),
near_win AS (
  SELECT row_number() OVER () AS wid, * FROM (
    SELECT DISTINCT item_id, least(13, len(w)) AS n, w[k : k + least(13, len(w)) - 1] AS g
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM item WHERE len(w) > 0))),
term AS (SELECT wid, item_id, n, unnest(range(0, n)) AS off, unnest(g) AS word FROM near_win),
said AS (SELECT r, k, w[k] AS word FROM place),
anchor AS (
  SELECT wid, item_id, n, off, word FROM term JOIN (SELECT word, count(*) AS often FROM said GROUP BY word) USING (word)
  QUALIFY row_number() OVER (PARTITION BY wid ORDER BY often, off) = 1),
start AS (
  SELECT DISTINCT a.wid, a.item_id, a.n, p.r, p.k - a.off + d AS s
  FROM anchor a JOIN said p ON p.word = a.word, (SELECT unnest(range(-2, 3)) AS d)),
near AS (
  SELECT c.r, c.item_id
  FROM start c JOIN term t USING (wid) JOIN said p ON p.r = c.r AND p.word = t.word AND abs(p.k - c.s - t.off) <= 2
  GROUP BY c.wid, c.item_id, c.n, c.r, c.s HAVING count(DISTINCT t.off) = c.n),
near_named AS (
  SELECT r, string_agg(id, ',' ORDER BY id) AS near_items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM near WHERE item_id IS NOT NULL
        EXCEPT SELECT r, item_id::VARCHAR FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  coalesce(near_items, '') AS near_items
FROM doc LEFT JOIN word USING (r) LEFT JOIN named USING (r) LEFT JOIN near_named USING (r)
"""
