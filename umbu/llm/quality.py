"""A quality classifier of supervised subword embeddings.

A document is the average of the learned vectors of its words, of pairs of words in a
row and of character n-grams, which share a hashed table; a linear layer and a softmax give its label.
Table and layer are trained together by stochastic gradient descent in numpy, on a
bounded sample of labelled rows whose features the cluster extracts. As both layers
are linear, scoring needs one number per bucket, and one lookup per feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.llm.tables import table
from umbu.llm.words import Piece, mix, pieces, running_sums, slice_hashes

BUCKET_BITS = 16
DIMENSIONS = 12
NGRAMS = (3, 4)
# Most labelled rows to learn from: those whose ids hash lowest.
TRAIN_ROWS = 3000
EPOCHS, RATE = 5, 0.3
# Tells the first word of a pair from the second.
_ORDER = np.uint64(0x9E3779B97F4A7C15)
# Small samples are gone over more often, so that there are about so many steps.
STEPS = 8000


@dataclass
class Model:
    """What one occurrence of each bucket adds to the log odds of label 1, and the bias."""

    weights: np.ndarray
    bias: float


def _features(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and n-grams of a piece, and the text each is of.

    A word is a run without ASCII white space, in its own case. N-grams are runs of
    characters of a word with one blank on either side.
    """
    n_texts = len(piece.bounds) - 1
    data = np.insert(piece.data, piece.bounds, 32)
    data[(data >= 9) & (data <= 13)] = 32
    bounds = piece.bounds + np.arange(n_texts + 1)  # the blank before each text
    sums = running_sums(data)
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    blank = data[chars] == 32
    edges = np.append(chars, len(data))
    inner = np.append(0, np.cumsum(blank))
    buckets, texts = [], []

    def add(starts: np.ndarray, ends: np.ndarray, salt: int) -> None:
        h = mix(slice_hashes(sums, starts, ends) + np.uint64(salt))
        buckets.append((h >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        texts.append(np.searchsorted(bounds, starts, side="right") - 1)

    for n in NGRAMS:
        if len(chars) < n:
            continue
        first = np.arange(len(chars) - n + 1)
        good = inner[first + n - 1] == inner[first + 1]
        first = first[good]
        add(edges[first], edges[first + n], n)
    word = ~blank
    starts = chars[np.flatnonzero(word[1:] & ~word[:-1]) + 1] if len(chars) > 1 else chars[:0]
    ends = chars[np.flatnonzero(~word[1:] & word[:-1]) + 1] if len(chars) > 1 else chars[:0]
    add(starts, ends, 99)
    # Two words in a row, in their order.
    whole = mix(slice_hashes(sums, starts, ends))
    pair = np.flatnonzero(texts[-1][1:] == texts[-1][:-1])
    h = mix(whole[pair] * _ORDER + whole[pair + 1])
    buckets.append((h >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
    texts.append(texts[-1][pair])
    text = np.concatenate(texts)
    # A gram that begins at a text's leading blank belongs to that text.
    return np.concatenate(buckets), np.minimum(text, n_texts - 1)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column(1)):
            buckets, texts = _features(piece)
            n = piece.last - piece.first
            both, counts = np.unique(texts.astype(np.int64) << BUCKET_BITS | buckets, return_counts=True)
            cuts = np.searchsorted(both >> BUCKET_BITS, np.arange(n + 1))
            ids = (both & (1 << BUCKET_BITS) - 1).astype(np.int32)
            parts = list(zip(cuts[:-1], cuts[1:]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(piece.first, n),
                    pa.array([ids[a:b].tobytes() for a, b in parts], pa.binary()),
                    pa.array([counts[a:b].astype(np.int32).tobytes() for a, b in parts], pa.binary()),
                ],
                names=["label", "ids", "counts"],
            )


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 3) -> Model:
    """Stochastic gradient descent over (label, bucket ids, counts)."""
    random = np.random.default_rng(seed)
    table_ = random.uniform(-1, 1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = np.zeros((DIMENSIONS, 2), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    rows = [(label, ids, (n / n.sum()).astype(np.float32)) for label, ids, n in rows if len(ids)]
    # Both labels weigh the same, however rare one is.
    of = np.bincount([r[0] for r in rows], minlength=2)
    weight = np.where(of > 0, len(rows) / (2 * np.maximum(of, 1)), 0)
    epochs = max(EPOCHS, STEPS // max(1, len(rows)))
    steps, step = epochs * len(rows), 0
    for _ in range(epochs if rows else 0):
        for k in random.permutation(len(rows)):
            label, ids, share = rows[k]
            rate = RATE * (1 - step / steps)
            step += 1
            vectors = table_[ids]
            hidden = share @ vectors
            logits = hidden @ layer + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[label] -= 1
            error *= min(weight[label], 10.0)
            back = layer @ error
            layer -= 0.1 * rate * np.outer(hidden, error)
            bias -= 0.01 * rate * error
            # An average's gradient is its share; a common scale keeps rare grams learning.
            scale = rate / np.sqrt(np.sum(share * share))
            table_[ids] -= np.outer(share * min(scale, 50.0), back)
    difference = layer[:, 1] - layer[:, 0]
    return Model((table_ @ difference).astype(np.float64), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, label: str, usable: Column) -> Model:
    """Learn ``label`` (0 or 1) from labelled rows that are ``usable``.

    At most ``TRAIN_ROWS`` rows, the lowest by a hash of the id; of an id's texts the
    one of smallest hash. Null and other
    labels are no labels; an id labelled both ways counts as 1 from a half up.
    Without rows, or with one label only, the model knows no more than that.
    """
    known = labels.where(F.col(label).isin(0, 1) & usable).groupBy("doc_id").agg(F.avg(label).alias("mean"))
    known = known.select("doc_id", (F.col("mean") >= 0.5).cast("int").alias("label"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    # Of an id's rows one, so that the sample is bounded however often an id occurs.
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "label", "text")).alias("one")
    rows = rows.groupBy("doc_id").agg(one).select("one.label", "one.text")
    found = rows.mapInArrow(_extract, "label int, ids binary, counts binary").collect()
    return fit([(r[0], np.frombuffer(r[1], np.int32), np.frombuffer(r[2], np.int32)) for r in found])


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value.weights, model.value.bias
        for batch in batches:
            odds = np.full(batch.num_rows, bias)
            for piece in pieces(batch.column(1)):
                buckets, texts = _features(piece)
                n = piece.last - piece.first
                sums = np.bincount(texts, weights[buckets], minlength=n)[:n]
                odds[piece.first : piece.last] += sums / np.maximum(1, np.bincount(texts, minlength=n)[:n])
            scores = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the chance of label 1 for every row, from its whole text alone.

    A null or empty text has no features and the model's bias as its score. Null
    and repeated ids are kept; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(_scorer(held), "doc_id bigint, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning: the id's checksum modulo 3 is 1; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def op8_quality_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from labels that are not held out;
    see ``train`` and ``score`` for all cases."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels, "quality", ~held_out())
    return score(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
