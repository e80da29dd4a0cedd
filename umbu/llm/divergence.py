"""How far the sources of a language differ in the words they use.

Terms are counted once, in the tasks that read the texts. Kept terms of a language are
numbered, in blocks of bounded size, and each group (a language's source) holds sorted
arrays of term numbers and counts, one pair of arrays per block. Each unordered pair of
groups is a task: the two groups' arrays of a block are co-grouped, a galloping search
intersects them, and overlapping and one-sided terms are priced. Terms that neither
group has all cost the same; their number is known, so they are priced together. The
price is symmetric, so that one task serves both directions.

All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from umbu.llm.tables import if_small, keep, table
from umbu.llm.words import LOWER, Piece, pieces, word_hashes, word_places

SHARE = 1_000_000_000
MIN_DOCS = 10
TOP = 10
# Terms of a block, on average; a group's arrays of a block are one row.
BLOCK_TERMS = 1 << 13
# A task passes its counts on when it has so many terms and groups.
ENTRIES = 1_000_000

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_PARTS = "lang string, one string, two string, part bigint, n_union bigint"


class _Counts:
    """Occurrences and documents of terms by group, gathered over pieces of text."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self._clear()

    def _clear(self) -> None:
        self.entries, self.parts, self.names = 0, [], []

    def group_of(self, langs: pa.Array, sources: pa.Array) -> np.ndarray:
        """A number for the group of each row."""
        lang, source = langs.dictionary_encode(), sources.dictionary_encode()
        pair = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
        different, at = np.unique(pair, return_inverse=True)
        names = [
            (lang.dictionary[k // len(source.dictionary)].as_py(), source.dictionary[k % len(source.dictionary)].as_py())
            for k in different.tolist()
        ]
        return np.array([self.groups.setdefault(n, len(self.groups)) for n in names], dtype=np.int64)[at]

    def add(self, piece: Piece, group: np.ndarray) -> None:
        """Count the terms of a piece; ``group`` has a number for each of its texts."""
        starts, ends = word_places(piece, _LETTERS)
        if not len(starts):
            return
        doc = np.searchsorted(piece.bounds, starts, side="right") - 1
        hashes, first, term = np.unique(word_hashes(piece, starts, ends), return_index=True, return_inverse=True)
        held, often = np.unique(doc * len(first) + term, return_counts=True)
        key, at = np.unique(group[held // len(first)] * len(first) + held % len(first), return_inverse=True)
        n, docs = np.bincount(at, weights=often).astype(np.int64), np.bincount(at)
        self.parts.append((hashes[key % len(first)], key // len(first), n, docs))
        low = LOWER[piece.data].tobytes()
        words = [low[s:e].decode() for s, e in zip(starts[first].tolist(), ends[first].tolist())]
        self.names.append((hashes, np.array(words, dtype=object)))
        self.entries += len(key)

    def taken(self) -> pa.RecordBatch | None:
        """All that was gathered, each term and group once."""
        if not self.parts:
            return None
        hashes, group, n, docs = (np.concatenate(x) for x in zip(*self.parts))
        named, first = np.unique(np.concatenate([h for h, _ in self.names]), return_index=True)
        words = np.concatenate([w for _, w in self.names])[first]
        key, at = np.unique(np.searchsorted(named, hashes) * len(self.groups) + group, return_inverse=True)
        langs, sources = zip(*self.groups)
        group = pa.array(key % len(self.groups))
        self._clear()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(langs, pa.string()).take(group), pa.array(sources, pa.string()).take(group),
                pa.array(words, pa.string()).take(pa.array(key // len(langs))),
                pa.array(np.bincount(at, weights=n).astype(np.int64)),
                pa.array(np.bincount(at, weights=docs).astype(np.int64)),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term and group, of many pieces at once."""
    counts = _Counts()
    for batch in batches:
        group = counts.group_of(batch.column(0), batch.column(1))
        for piece in pieces(batch.column(2)):
            counts.add(piece, group[piece.first : piece.last])
            if counts.entries > ENTRIES:
                yield counts.taken()
    if (rest := counts.taken()) is not None:
        yield rest


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, its occurrences n, and the documents that hold it.

    Terms are runs of A-Z, a-z and characters beyond ASCII, A-Z lower-cased. Null
    texts, languages and sources are empty ones. Within one task terms are told apart
    by 64-bit hashes, across tasks by their characters.
    """
    part = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = part.mapInArrow(_counted, _COUNTS).groupBy("lang", "source", "term")
    return counts.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def gallop(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    """For each number of a sorted array the first place in another that is not less.

    Each search starts where the number would lie if both arrays were even, doubles
    its step until the number is enclosed, and halves from there.
    """
    n = len(large)
    at = np.arange(len(small)) * n // max(1, len(small))
    low, high, step = at.copy(), at.copy(), 1
    while (down := (low > 0) & (large[np.maximum(low - 1, 0)] >= small) if n else np.zeros(len(small), bool)).any():
        high[down] = low[down] - 1
        low[down] = np.maximum(low[down] - step, 0)
        step *= 2
    step = 1
    while (up := (high < n) & (large[np.minimum(high, n - 1)] < small) if n else np.zeros(len(small), bool)).any():
        low[up] = high[up] + 1
        high[up] = np.minimum(high[up] + step, n)
        step *= 2
    while (open_ := low < high).any():
        middle = (low + high) // 2
        less = open_ & (large[np.minimum(middle, n - 1)] < small)
        low, high = np.where(less, middle + 1, low), np.where(open_ & ~less, middle, high)
    return low


def shares(n: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SHARE * (n + 2) / total), digit by digit: no product leaves 64 bits."""
    out, rest = np.zeros(len(n), dtype=np.int64), np.asarray(n, dtype=np.int64) + 2
    out += rest // total
    rest = rest % total
    for _ in range(9):
        rest = rest * 10
        out = out * 10 + rest // total
        rest = rest % total
    return out + 1


def _price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _merge(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Price the terms of a block that one or both of two groups have."""
    lang, one, two = (key[k].as_py() for k in range(3))
    totals = (left if left.num_rows else right).select(["one_total", "two_total"]).to_pylist()[0]
    flat = lambda side, name: side[name].combine_chunks().flatten().to_numpy().astype(np.int64)
    ids, counts = ([flat(side, name) for side in (left, right)] for name in ("ids", "counts"))
    totals = [totals["one_total"], totals["two_total"]]
    p = [shares(c, t) for c, t in zip(counts, totals)]
    absent = [shares(np.zeros(1, np.int64), t) for t in totals]
    s, l = (0, 1) if len(ids[0]) <= len(ids[1]) else (1, 0)  # noqa: E741
    at = gallop(ids[s], ids[l])
    both = at < len(ids[l])
    both[both] = ids[l][at[both]] == ids[s][both]
    only = np.ones(len(ids[l]), dtype=bool)
    only[at[both]] = False
    part = (
        _price(p[s][both], p[l][at[both]]).sum()
        + _price(p[s][~both], absent[l]).sum()
        + _price(p[l][only], absent[s]).sum()
    )
    union = len(ids[s]) + int(only.sum())
    return pa.table(
        {"lang": [lang], "one": [one], "two": [two], "part": [int(part)], "n_union": [union]},
        schema=pa.schema([("lang", pa.string()), ("one", pa.string()), ("two", pa.string()),
                          ("part", pa.int64()), ("n_union", pa.int64())]),
    )


def _share(n: str, total: str) -> Column:
    return F.expr(f"1 + (cast({SHARE} as decimal(38,0)) * ({n} + 2)) div {total}")


def _value(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank; see the module.

    Part ``pair``: a source against each other one of its language, all of them. Part
    ``term``: the ``top`` terms a source has more of than its language. Ranks are by
    value, then by the item's bytes. Every group that occurs is there, also without
    terms; a language without kept terms has pairs of value 0 and no terms. Rows count
    as often as they occur, their ids are not looked at; an empty table gives no rows.
    """
    texts = docs.select("lang", "source", "text")
    counts = keep(term_counts(texts), "term-counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    terms = keep(terms.where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    langs = keep(terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("n")), "langs")
    largest = langs.agg(F.max("v")).first()[0] or 0
    block = F.pmod(F.xxhash64("term"), F.lit(largest // BLOCK_TERMS + 1)).cast("int")
    number = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term"))
    terms = keep(terms.withColumn("block", block).withColumn("id", number), "numbered-terms")
    held = counts.drop("docs").join(if_small(terms), ["lang", "term"])
    held = keep(held, "held")
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    lang_totals = langs.select("lang", "v", F.expr("n + 2 * v").alias("lang_total"))
    groups = (
        texts.select(name("lang"), name("source")).distinct()
        .join(sums, ["lang", "source"], "left").join(if_small(lang_totals), "lang", "left")
        .select("lang", "source", "v", "lang_total", F.expr("coalesce(n, 0) + 2 * v").alias("total"))
    )
    groups = keep(groups, "groups")
    pairs = _pairs(groups, held)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(by_value)
    more = held.join(if_small(groups), ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        _share("n", "total").alias("p"), _share("lang_n", "lang_total").alias("q"),
    )
    more = more.where("p > q").select("lang", "source", "item", _value("p", "q").alias("value"))
    more = more.withColumn("rank", ranked).where(F.col("rank") <= top)
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(pairs.withColumn("rank", ranked), "pair").union(columns(more, "term"))


def _pairs(groups: DataFrame, held: DataFrame) -> DataFrame:
    """lang, source, item, value of all ordered pairs of a language's sources."""
    one = groups.select("lang", "v", F.col("source").alias("one"), F.col("total").alias("one_total"))
    two = groups.select("lang", F.col("source").alias("two"), F.col("total").alias("two_total"))
    pairs = keep(one.join(if_small(two), "lang").where("one < two"), "pairs")
    # A block's arrays of a group, as long as the block at most.
    arrays = held.groupBy("lang", "source", "block").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("x"))
    arrays = keep(
        arrays.select("lang", "source", "block", F.col("x.id").alias("ids"), F.col("x.n").alias("counts")), "arrays"
    )
    key = ["lang", "one", "two", "block"]
    sides = [
        arrays.withColumnRenamed("source", side).join(if_small(pairs.drop("v")), ["lang", side])
        .select(*[F.col(c).alias(c) for c in (*key, "one_total", "two_total", "ids", "counts")])
        for side in ("one", "two")
    ]
    parts = sides[0].groupBy(*key).cogroup(sides[1].groupBy(*key)).applyInArrow(_merge, _PARTS)
    parts = parts.groupBy("lang", "one", "two").agg(F.sum("part").alias("part"), F.sum("n_union").alias("n_union"))
    absent = pairs.select(
        "lang", "one", "two", "v", _share("0L", "one_total").alias("p"), _share("0L", "two_total").alias("q")
    ).withColumn("absent", _value("p", "q"))
    whole = absent.join(parts, ["lang", "one", "two"], "left").select(
        "lang", "one", "two",
        F.expr("coalesce(part, 0) + coalesce((v - coalesce(n_union, 0)) * absent, 0)").alias("value"),
    )
    whole = keep(whole, "divergences")
    way = lambda a, b: whole.select("lang", F.col(a).alias("source"), F.col(b).alias("item"), "value")
    return way("one", "two").union(way("two", "one"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of sources and the terms that mark them; see ``divergences``."""
    return divergences(table(spark, sf_dir, "documents"))


SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
word AS (SELECT r, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM word GROUP BY ALL HAVING count(DISTINCT r) >= 10),
held AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, langs.v, langs.n + 2 * langs.v AS lang_total,
    (SELECT coalesce(sum(h.n), 0) FROM held h WHERE h.lang = g.lang AND h.source = g.source)::HUGEINT + 2 * langs.v AS total
  FROM (SELECT DISTINCT lang, source FROM doc) g LEFT JOIN langs USING (lang)),
price AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 2)) // g.total AS p,
    1 + (1000000000::HUGEINT * (k.n + 2)) // g.lang_total AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
    FROM price x JOIN price y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (
  SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM price WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, 'pair' AS part FROM pair UNION ALL SELECT *, 'term' AS part FROM term)
SELECT lang, source, part, item, value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 10
"""
