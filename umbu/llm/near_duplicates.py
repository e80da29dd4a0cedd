"""SimHash near-duplicates with pigeonhole blocks.

A fingerprint is cut into a few more blocks than bits may differ, so that two
close ones agree in whole blocks: with b blocks and 4 differing bits, in b - 4 of
them at least. Fingerprints are joined on every choice of b - 4 blocks, and pairs
are verified by their Hamming distance. b follows from the number of different
fingerprints, so that a key is wide enough for that many: it alters the work, not
the links.

Only different fingerprints are compared. In a bucket each is first compared with
the smallest one, which is linear and puts dense groups into one component; what
is left are comparisons between different components, without those inside the
largest component of a bucket. No link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from umbu.llm.components import components
from umbu.llm.tables import if_small, keep, only, same, table, text_hash

SHINGLE = 4
SEED = 42
DISTANCE = 4
# Hashes of one text are turned into bit counts so many at a time.
_CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash over word shingles, as a signed 64-bit number; no words give 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    width = min(shingle, len(words))
    n = len(words) - width + 1
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        to = min(n, at + _CHUNK)
        cuts = zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist())
        digests = b"".join(map(xxh64_digest, [joined[a:b] for a, b in cuts], repeat(SEED)))
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            found = [fingerprint(x.as_py() or b"", shingle) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())],
                names=["doc_id", "text_hash", "fp"],
            )

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash and fingerprint of every row; a null text has no words.

    Words are runs without ASCII white space, A-Z lower-cased. Their shingles are
    joined by one space and hashed with XXH64, repeats included; a text with fewer
    words is one shingle. A bit is set if it is set in over half of the hashes.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), text_hash(), "text")
    return rows.mapInArrow(_fingerprints(shingle), "doc_id bigint, text_hash bigint, fp bigint")


def _masks(blocks: int, distance: int) -> list[int]:
    """Bit masks of all choices of blocks that close fingerprints may agree in."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(sum(chosen)) for chosen in combinations(block, blocks - distance)]


def _blocks_for(n: int, distance: int) -> int:
    """Fewest blocks for keys as wide as ``n`` fingerprints need."""
    blocks = distance + 2
    while 64 * (blocks - distance) // blocks < max(n, 2).bit_length() and blocks < distance + 6:
        blocks += 1
    return blocks


def _close(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def fingerprint_groups(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, root) for every different fingerprint that has a link.

    ``fps`` is a kept frame with a column fp of different fingerprints. Groups are
    the components of "at most ``distance`` bits differ"; root is the group's
    smallest fingerprint.
    """
    masks = _masks(_blocks_for(fps.count(), distance), distance)
    buckets = F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key"))
        for i, mask in enumerate(masks)
    ])
    keyed = lambda df: df.select("*", F.inline(buckets))
    keys = keyed(fps.select("fp"))
    heads = keys.groupBy("t", "key").agg(F.min("fp").alias("head"), F.count("fp").alias("n"))
    near = (
        heads.where("n > 1")
        .join(keys, ["t", "key"])
        .where((F.col("head") != F.col("fp")) & _close("head", "fp", distance))
        .select("head", "fp")
    )
    first = components(near, "fingerprint-links")
    part = F.coalesce("root", "fp").alias("part")
    placed = fps.select("fp").join(first, F.col("fp") == F.col("node"), "left").select("fp", part)
    placed = keep(placed, "fingerprint-parts")
    rows = keyed(placed)
    largest = (
        rows.groupBy("t", "key", "part").agg(F.count("fp").alias("n"))
        .groupBy("t", "key").agg(F.max(F.struct("n", "part")).alias("top"), F.count("n").alias("parts"))
        .where("parts > 1")
        .select("t", "key", F.col("top.part").alias("top"))
    )
    others = rows.join(largest, ["t", "key"]).where("part != top").select(
        "t", "key", F.col("fp").alias("other"), F.col("part").alias("other_part")
    )
    links = (
        others.join(rows, ["t", "key"])
        .where((F.col("part") != F.col("other_part")) & _close("fp", "other", distance))
        .select("part", "other_part")
    )
    second = components(links, "part-links")
    out = placed.join(second, F.col("part") == F.col("node"), "left")
    return out.select("fp", F.coalesce("root", "part").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Per row: doc_id, text_hash, fp, root and component_id.

    root is the group's smallest fingerprint, component_id its smallest doc_id.

    Rows without words have fingerprint 0 and are linked like any others. Rows
    without doc_id take part; a group of such rows only has no component_id.
    Repeated rows each have a row. An empty table gives no rows.
    """
    rows = keep(fingerprints(docs, shingle), "fingerprints")
    fps = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "different-fingerprints")
    groups = keep(fingerprint_groups(fps, distance), "fingerprint-groups")
    ids = fps.join(groups, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    named = keep(groups.join(ids, "root"), "fingerprint-components")
    return rows.join(if_small(named), "fp").select(
        "doc_id", "text_hash", "fp", "root", "component_id"
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group: the one of smallest doc_id, with all its columns.

    Ids that are null come last; among rows of one id the smallest text hash stays,
    and of rows equal in both one stays.
    """
    found = keep(near_duplicates(docs), "near-duplicates")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = found.groupBy("root").agg(F.min(order).alias("best"))
    chosen = keep(best.select("best.doc_id", "best.text_hash"), "chosen")
    rows = found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    side = if_small(chosen.withColumn("chosen", F.lit(True)))
    marked = rows.join(side, same(rows, side, ["doc_id", "text_hash"]), "left").select(
        rows["doc_id"], rows["text_hash"], "copies", F.coalesce("chosen", F.lit(False)).alias("chosen")
    )
    marked = keep(marked, "copies")
    left = only(docs, keep(marked.where("not chosen"), "dropped"), "left_anti")
    again = keep(marked.where("chosen and copies > 1"), "repeated-rows")
    if not again.count():
        return left
    once = only(left, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return only(left, again, "left_anti").unionByName(once)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document; see ``near_duplicates`` for all cases."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
