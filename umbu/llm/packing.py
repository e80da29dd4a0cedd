"""Conflict-constrained best-fit packing of documents into training sequences.

Pieces of documents are spread by hash over groups of about equal numbers. In a
group, pieces go by falling size into the open bin with the least room that still
holds them: the bins are ordered by residual, and the search goes on from the
first that is large enough to the next, until one has neither the piece's source
nor its duplicate cluster in its bitmaps. If none has, a bin is opened.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.llm.near_duplicates import near_duplicates
from umbu.llm.tables import if_small, keep, same, table, text_hash

CAPACITY = 2048
# Pieces of a group, on average. Groups are packed alone, each by one task.
GROUP_PIECES = 4096

_PACKED = "doc_id bigint, text_hash bigint, piece int, first_word bigint, n_words bigint, bin bigint, slot int, offset bigint"


def best_fit(sizes, sources, clusters, capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin, slot and offset of each piece; pieces come by falling size.

    ``sources`` and ``clusters`` are small numbers that give the bits.
    """
    order: list[tuple[int, int]] = []  # open bins: residual and number
    residual: list[int] = []
    held_sources: list[int] = []
    held_clusters: list[int] = []
    held: list[int] = []
    bins, slots, offsets = [], [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        source_bit, cluster_bit = 1 << source, 1 << cluster
        at = bisect_left(order, (size, -1))
        while at < len(order) and (
            held_sources[order[at][1]] & source_bit or held_clusters[order[at][1]] & cluster_bit
        ):
            at += 1
        if at < len(order):
            number = order.pop(at)[1]
        else:
            number = len(residual)
            residual.append(capacity)
            held_sources.append(0)
            held_clusters.append(0)
            held.append(0)
        bins.append(number)
        slots.append(held[number])
        offsets.append(capacity - residual[number])
        residual[number] -= size
        held_sources[number] |= source_bit
        held_clusters[number] |= cluster_bit
        held[number] += 1
        if residual[number]:
            insort(order, (residual[number], number))
    return bins, slots, offsets


def _bits(values: pa.Array) -> list[int]:
    """Small numbers for values; a null is a value of its own kind each time."""
    codes = values.dictionary_encode()
    out = codes.indices.to_numpy(zero_copy_only=False)
    missing = np.isnan(out) if out.dtype.kind == "f" else np.zeros(len(out), bool)
    fresh = len(codes.dictionary) + np.arange(len(out))
    return np.where(missing, fresh, np.where(missing, 0, out)).astype(np.int64).tolist()


def _packer(capacity: int):
    def run(key, group):
        order = [("n_words", "descending"), ("doc_id", "ascending"), ("text_hash", "ascending"), ("piece", "ascending")]
        group = group.sort_by(order).combine_chunks()
        column = lambda name: group.column(name).combine_chunks()
        bins, slots, offsets = best_fit(
            group.column("n_words").to_pylist(), _bits(column("source")), _bits(column("cluster")), capacity
        )
        number = np.array(bins, dtype=np.int64) + (int(key[0].as_py()) << 32)
        return pa.table(
            {
                **{n: group.column(n) for n in ("doc_id", "text_hash", "piece", "first_word", "n_words")},
                "bin": pa.array(number, pa.int64()),
                "slot": pa.array(slots, pa.int32()),
                "offset": pa.array(offsets, pa.int64()),
            }
        )

    return run


def count_words(text: str | Column = "text") -> Column:
    """Words between ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _equal_text() -> Column:
    """Equal for texts that are equal but for case and white space."""
    return F.xxhash64(F.btrim(F.lower(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))))


def near_clusters(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and cluster: the group of documents with close fingerprints.

    Texts equal but for case and white space have equal fingerprints, so they are in
    one group; groups are those of ``near_duplicates``. Rows equal in id and text have
    one entry.
    """
    found = near_duplicates(docs).groupBy("doc_id", "text_hash").agg(F.min("root").alias("cluster"))
    return keep(found, "near-clusters")


def pack(docs: DataFrame, capacity: int = CAPACITY, clusters: DataFrame | None = None) -> DataFrame:
    """Places of all words of all documents in bins of ``capacity`` words.

    One row per piece: doc_id, text_hash, piece, first_word, n_words, bin, slot (in
    the order of packing) and offset of its first word in the bin. A document of
    more words is cut into pieces of ``capacity`` and a rest; a full piece has a
    bin to itself. No bin holds two pieces of one source or of one cluster, which
    are texts equal but for case and white space; pieces of one document are of one
    cluster. Null sources are no source in common.

    A document without words has one piece of no words, in no bin (bin, slot and
    offset are null). Repeated rows are packed each for itself. An empty table
    gives no rows.
    """
    sized = docs.select(
        F.col("doc_id").cast("bigint"), text_hash(), F.col("source").cast("string"), count_words().alias("words"),
        *([_equal_text().alias("cluster")] if clusters is None else []),
    )
    if clusters is not None:
        side = if_small(clusters)
        sized = sized.join(side, same(sized, side, ["doc_id", "text_hash"]), "left").select(
            sized["doc_id"], sized["text_hash"], "source", "cluster", "words"
        )
    number = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("words") / capacity).cast("int") - 1, F.lit(0))))
    pieces = sized.withColumn("piece", number).withColumn("first_word", F.col("piece").cast("bigint") * capacity)
    pieces = keep(
        pieces.select(
            "doc_id", "text_hash", "source", "cluster", "piece", "first_word",
            F.least(F.lit(capacity), F.col("words") - F.col("first_word")).cast("bigint").alias("n_words"),
        ),
        "pieces",
    )
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    group = F.pmod(F.xxhash64("doc_id", "text_hash", "piece"), F.lit(groups)).cast("int")
    packed = (
        pieces.where("n_words > 0").withColumn("group", group).groupBy("group")
        .applyInArrow(_packer(capacity), _PACKED)
    )
    nothing = pieces.where("n_words = 0").select(
        "doc_id", "text_hash", "piece", "first_word", "n_words",
        F.lit(None).cast("bigint").alias("bin"), F.lit(None).cast("int").alias("slot"),
        F.lit(None).cast("bigint").alias("offset"),
    )
    return packed.unionByName(nothing)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed, near copies apart; see ``pack`` for all cases."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return pack(docs, clusters=near_clusters(docs)).drop("text_hash")
