"""Exact top-k by inner product with MaxScore over an inverted index of vectors.

A term is a dimension and a sign. The index is written in segments, each with the
postings of every term: the vectors with a number of that sign there, and the numbers.
A query's term scores at most its weight times the list's largest number, and nothing
where the signs differ. Terms are ordered by that bound. The first of them, whose bounds
together stay below the score to beat, are non-essential: a vector in none of the
other lists cannot get in. The essential lists are traversed; what they gather is
probed in the other lists while it is competitive.

The score to beat is the k-th best among a bounded sample and what the task has seen:
always a score that k candidates reach, so nothing that belongs is lost. Tasks
return their best, which are merged by a window per query.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from umbu.llm.tables import about, keep, table

RESULTS = 10
SCALE = 1024
EVERY = 100
# Vectors of an index segment at most.
SEGMENT_ROWS = 8192
# Queries, and numbers of queries, that are sent to the tasks at once at most.
BLOCK_QUERIES = 4096
BLOCK_NUMBERS = 1 << 20
# Lists with this part of a segment's vectors are held by place, others are searched.
DENSE = 16
# Vectors whose scores give the first score to beat.
SEEDS = 1000

_SEGMENT = "rows binary, ids array<bigint>, terms binary, counts binary, places binary, numbers binary, wide boolean"
_FOUND = "query bigint, query_id bigint, row bigint, vec_id bigint, score string"
_EXACT = 1 << 53
_LONG = (1 << 63) - 1
# Scores beyond this, so many digits that Spark's numbers do not hold them, are alike.
_MOST = 10**38 - 1


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """row, vec_id and floor(1024 * x) of each number, as doubles.

    Vectors that are null or hold a null, or a number that is not finite before or
    after, take no part. ``row`` tells rows apart whose ids are missing or repeated.
    """
    scaled = F.transform("embedding", lambda x: x.cast("double") * SCALE)
    good = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & F.coalesce(good, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint"), scaled.alias("vec")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length; missing numbers are 0, which adds nothing to a score."""
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, int)
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(column), int(lengths.max(initial=0))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, SEGMENT_ROWS):
            part = batch.slice(first, SEGMENT_ROWS)
            numbers = _matrix(part.column(2))
            place, dimension = np.nonzero(numbers)
            held = numbers[place, dimension]
            term = 2 * dimension + (held < 0)
            order = np.argsort(term, kind="stable")
            terms, counts = np.unique(term, return_counts=True)
            data = [terms.astype(np.int32), counts.astype(np.int32), place[order].astype(np.int32), held[order]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.column(0).to_numpy().tobytes()], pa.binary()),
                    pa.array([part.column(1).to_pylist()], pa.list_(pa.int64())),
                    *[pa.array([x.tobytes()], pa.binary()) for x in data],
                    pa.array([bool((np.abs(numbers) >= _EXACT).any())]),
                ],
                names=["rows", "ids", "terms", "counts", "places", "numbers", "wide"],
            )


def build_index(vectors: DataFrame) -> DataFrame:
    """Segments of the inverted index of ``whole_numbers``, built without a shuffle."""
    return vectors.mapInArrow(_segments, _SEGMENT)


def _exact(numbers: np.ndarray) -> np.ndarray:
    """Python's whole numbers, for scores beyond what doubles hold exactly."""
    return np.array([int(x) for x in numbers.ravel()], dtype=object).reshape(numbers.shape)


def _fits(queries: np.ndarray, largest: float) -> bool:
    """Whether all sums of products are whole numbers that doubles hold exactly."""
    return not queries.size or float(np.abs(queries).max()) * largest * queries.shape[1] < _EXACT


class Segment:
    """Postings by term, and the bound of each."""

    def __init__(self, record: dict):
        self.rows = np.frombuffer(record["rows"], dtype=np.int64)
        self.ids = record["ids"]
        terms, counts, self.places = (np.frombuffer(record[c], dtype=np.int32) for c in ("terms", "counts", "places"))
        self.numbers = np.frombuffer(record["numbers"])
        self.largest = float(np.abs(self.numbers).max(initial=0))
        ends = np.cumsum(counts, dtype=np.int64)
        self.lists = {int(t): (int(e - n), int(e)) for t, n, e in zip(terms, counts, ends)}

    def exact(self) -> None:
        self.numbers = _exact(self.numbers)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        first, end = self.lists.get(term, (0, 0))
        return self.places[first:end], self.numbers[first:end]

    @functools.cached_property
    def bounds(self) -> dict[int, object]:
        """The largest number of each list, without its sign."""
        return {t: abs(self.numbers[a:b]).max() for t, (a, b) in self.lists.items()}

    @functools.cached_property
    def columns(self) -> dict[int, np.ndarray]:
        """Numbers by vector, of the lists that hold a good part of the vectors."""
        out = {}
        for term, (first, end) in self.lists.items():
            if end - first >= len(self.rows) // DENSE:
                out[term] = np.zeros(len(self.rows), dtype=self.numbers.dtype)
                out[term][self.places[first:end]] = self.numbers[first:end]
        return out

    def probe(self, term: int, alive: np.ndarray) -> np.ndarray:
        """The numbers that some vectors have in a list; 0 where they are not in it."""
        if term in self.columns:
            return self.columns[term][alive]
        places, numbers = self.postings(term)
        near = np.minimum(np.searchsorted(places, alive), len(places) - 1)
        return np.where(places[near] == alive, numbers[near], 0)

    def search(self, query: np.ndarray, beat: object | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of all vectors that score at least ``beat``."""
        used = np.flatnonzero(query)
        # Lists whose numbers have the query's sign add, the others take away.
        adding = [(int(2 * d + (query[d] < 0)), query[d]) for d in used]
        adding = [(abs(w) * self.bounds[t], t, w) for t, w in adding if t in self.lists]
        adding.sort(key=lambda x: (x[0], x[1]))
        taking = [(0, int(2 * d + (query[d] > 0)), query[d]) for d in used]
        taking = [x for x in taking if x[1] in self.lists]
        scores = np.zeros(len(self.rows), dtype=self.numbers.dtype)
        split, below = 0, 0
        if beat is None or beat <= 0:
            alive, split = np.arange(len(self.rows)), len(adding)  # a vector in no list may get in
        else:
            while split < len(adding) and below + adding[split][0] < beat:
                below += adding[split][0]
                split += 1
            touched = np.zeros(len(self.rows), dtype=bool)
            for _, term, weight in adding[split:]:
                if term in self.columns:
                    scores += self.columns[term] * weight
                    touched |= self.columns[term] != 0
                else:
                    places, numbers = self.postings(term)
                    scores[places] += numbers * weight
                    touched[places] = True
            alive = np.flatnonzero(touched)
            alive = alive[(scores[alive] + below >= beat).astype(bool)]
        rest = adding[:split]
        remaining = sum(x[0] for x in rest)
        at = scores[alive]
        # The heaviest lists first: they decide soonest who is still competitive.
        for bound, term, weight in sorted([*rest, *taking], key=lambda x: -abs(x[2]) * self.bounds[x[1]]):
            if not len(alive):
                break
            at = at + self.probe(term, alive) * weight
            remaining -= bound
            if beat is not None:
                good = (at + remaining >= beat).astype(bool)
                if not good.all():
                    alive, at = alive[good], at[good]
        return alive, at


def _order(score, vec_id, row) -> tuple:
    """Higher scores first, then smaller ids, missing ones last, then rows."""
    return -score, vec_id is None, vec_id or 0, row


def _search(batches: Iterator[pa.RecordBatch], block: dict, k: int) -> Iterator[pa.RecordBatch]:
    """The k best vectors of each query among the segments of a task."""
    queries, best = block["queries"], [[] for _ in block["rows"]]
    beat = list(block["beat"])
    for batch in batches:
        for record in batch.to_pylist():
            segment = Segment(record)
            small = _fits(queries, segment.largest)
            if not small:
                segment.exact()
            for q, row in enumerate(block["rows"]):
                query = queries[q] if small else _exact(queries[q])
                # One more, since the query itself may be among them.
                places, scores = segment.search(query, beat[q])
                if not small:
                    scores = np.array([max(-_MOST, min(_MOST, x)) for x in scores], dtype=object)
                other = segment.rows[places] != row
                places, scores = places[other], scores[other]
                if len(places) > 4 * k:
                    kth = np.partition(scores, len(scores) - k)[len(scores) - k] if small else sorted(scores)[-k]
                    near = (scores >= kth).astype(bool)
                    places, scores = places[near], scores[near]
                found = [
                    (int(s), segment.ids[p], int(segment.rows[p])) for p, s in zip(places.tolist(), scores.tolist())
                ]
                best[q] = sorted(best[q] + found, key=lambda x: _order(*x))[:k]
                if len(best[q]) == k and best[q][-1][0] > -_MOST:
                    beat[q] = best[q][-1][0] if beat[q] is None else max(beat[q], best[q][-1][0])
    out = [(q, *x) for q, found in enumerate(best) for x in found]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([block["rows"][q] for q, *_ in out], pa.int64()),
            pa.array([block["ids"][q] for q, *_ in out], pa.int64()),
            pa.array([x[3] for x in out], pa.int64()),
            pa.array([x[2] for x in out], pa.int64()),
            pa.array([str(x[1]) for x in out], pa.string()),
        ],
        names=["query", "query_id", "row", "vec_id", "score"],
    )


def _first_to_beat(queries: np.ndarray, rows: list[int], seeds: pa.Table, k: int) -> list[object | None]:
    """The k-th best score of each query among the sample, where that has so many."""
    if seeds.num_rows <= k:
        return [None] * len(rows)
    sample, of = _matrix(seeds["vec"].combine_chunks()), seeds["row"].to_numpy()
    width = min(sample.shape[1], queries.shape[1])
    if not _fits(queries, float(np.abs(sample).max(initial=0))):
        return [None] * len(rows)
    out = []
    for query, row in zip(queries, rows):
        scores = (sample[:, :width] @ query[:width])[of != row]
        out.append(int(np.partition(scores, len(scores) - k)[len(scores) - k]))
    return out


def search(vectors: DataFrame, queries: DataFrame, k: int = RESULTS) -> DataFrame:
    """The k best of ``vectors`` for each of ``queries``, both of ``whole_numbers``.

    query_id, rank, vec_id, score. A query's own row is left out; another row of its id
    is a candidate. Ties go to the smaller id (missing ids last), then to the earlier
    row; repeated rows have ranks of their own. Vectors may differ in length: missing
    numbers are 0. A score beyond a long is given as the nearest long, in the order of
    the exact scores, of which those of over 38 digits are alike. Fewer candidates give fewer rows, an empty table none.
    """
    n = vectors.count()
    seeds = about(vectors, SEEDS, n, "row").toArrow()
    index = keep(build_index(vectors), "index")
    found = None
    for block in _blocks(queries):
        numbers = _matrix(block["vec"].combine_chunks())
        rows = block["row"].to_pylist()
        sent = {
            "queries": numbers, "rows": rows, "ids": block["vec_id"].to_pylist(),
            "beat": _first_to_beat(numbers, rows, seeds, k),
        }
        part = keep(index.mapInArrow(functools.partial(_search, block=sent, k=k), _FOUND), "found")
        found = part if found is None else found.union(part)
    if found is None:
        found = vectors.sparkSession.sql(
            "SELECT 0L AS query, 0L AS query_id, 0L AS row, 0L AS vec_id, '0' AS score WHERE false"
        )
    score = F.col("score").cast("decimal(38,0)")
    order = Window.partitionBy("query").orderBy(F.desc("exact"), F.asc_nulls_last("vec_id"), "row")
    ranked = found.withColumn("exact", score).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    near = F.greatest(F.least("exact", F.lit(_LONG).cast("decimal(38,0)")), F.lit(-_LONG).cast("decimal(38,0)"))
    return ranked.select("query_id", "rank", "vec_id", near.cast("bigint").alias("score"))


def _blocks(queries: DataFrame) -> Iterator[pa.Table]:
    """The queries in blocks of bounded size, chosen by a hash of the row."""
    n, numbers = queries.agg(F.count(F.lit(1)), F.sum(F.size("vec").cast("bigint"))).first()
    blocks = max(-(-2 * n // BLOCK_QUERIES), -(-2 * (numbers or 0) // BLOCK_NUMBERS)) if n else 0
    at = F.pmod(F.xxhash64("row"), F.lit(max(1, blocks)))
    for block in range(blocks):
        part = queries.where(at == block).toArrow()
        if part.num_rows:
            yield part


def op13_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector; see ``search``."""
    vectors = keep(whole_numbers(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")), "vectors")
    return search(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::HUGEINT) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r AS query, c.r AS row, q.vec_id AS query_id, c.vec_id,
    coalesce(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id, row)::INTEGER AS rank FROM scored)
WHERE rank <= 10
"""
