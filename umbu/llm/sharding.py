"""Sharding by a k-d tree over metadata, balanced by bytes.

A node is split along its widest metadata dimension at the weighted median, so that
both sides hold the bytes of their shards, until every leaf has the target size. A
median is a search over one key, the dimension's value and then the text's checksum:
sums over at most ``BUCKETS`` ranges of keys per node say in which range it lies, until
so few texts are left there that their sums, in order, show the place. All nodes of a
level are searched together; each search is a grouped sum, combined before it is
shuffled. Only then are a node's shards given to its sides, by the bytes they got.

Copies of a text are one point with the bytes of all. The point at the median goes
to the side that lacks more, unless it is so heavy that the sides would differ:
then its rows are divided by a hash of their ids, at a place found by the same search.

Only DataFrame functions are used; the driver holds a few numbers per node.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from umbu.llm.tables import if_small, keep, table, text_hash

SHARDS = 8
BUCKETS = 1 << 14
# So many texts of a node, or of a range of one, are put in order at once.
ORDERED = 100_000
# A point with more of a shard's bytes than this is divided.
HEAVY = 1 / 200
# Rows of a shard that are numbered together.
CHUNK_ROWS = 8192

_POINT = ["text_crc32", "size", "text_hash"]
_DIMENSIONS = ["n_chars", "source_code", "lang_code"]
# Places of rows among the copies of a text: from 0 to before this.
_PLACES = 1 << 62


@dataclass
class _Cut:
    """A search in a node for the key up to which ``need`` of its bytes lie."""

    lo: int
    hi: int
    need: float
    values: int
    step: int = 0
    before: list[int] = field(default_factory=lambda: [0, 0])  # bytes and rows
    at: list[int] = field(default_factory=lambda: [0, 0])

    def narrow(self) -> None:
        few = self.values <= ORDERED or self.hi - self.lo < BUCKETS
        self.step = 1 if few else (self.hi - self.lo) // BUCKETS + 1

    def goes_left(self, whole: Sequence[int]) -> bool:
        """Whether the key itself belongs before the cut; no side stays without rows."""
        after = whole[1] - self.before[1] - self.at[1]
        if not self.before[1] or not after:
            return after > 0 or not self.before[1]
        return 2 * (self.need - self.before[0]) >= self.at[0]


def _literals(spark: SparkSession, rows: Iterable[Sequence], ddl: str) -> DataFrame:
    """A few rows as SQL ``VALUES``, which no Python worker is needed for."""
    names, kinds = zip(*(c.split() for c in ddl.split(", ")))
    values = ", ".join("(" + ", ".join(f"{v!r}{'D' * (k == 'double')}" for v, k in zip(r, kinds)) + ")" for r in rows)
    columns = ", ".join(f"CAST({n} AS {k}) AS {n}" for n, k in zip(names, kinds))
    return F.broadcast(spark.sql(f"SELECT {columns} FROM VALUES {values} AS t({', '.join(names)})"))


def _search(values: DataFrame, cuts: dict[int, _Cut]) -> None:
    """Find every cut's key among ``values`` of node, key, weight (bytes) and n (rows).

    Afterwards lo is the key, ``at`` what lies there and ``before`` what lies before it.
    """
    open_ = dict(cuts)
    for cut in open_.values():
        cut.narrow()
    while open_:
        ranges = [(node, c.lo, c.hi, c.step, float(c.need - c.before[0])) for node, c in open_.items()]
        near = values.join(
            _literals(values.sparkSession, ranges, "node int, lo bigint, hi bigint, step bigint, need double"), "node"
        ).where(F.col("key").between(F.col("lo"), F.col("hi")))
        bucket = F.expr("(key - lo) div step").alias("bucket")
        sums = near.groupBy("node", "need", bucket).agg(
            F.sum("weight").alias("weight"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("values")
        )
        order = Window.partitionBy("node").orderBy("bucket")
        before = [(F.sum(c).over(order) - F.col(c)).alias(f"{c}_before") for c in ("weight", "n")]
        last = F.max("bucket").over(Window.partitionBy("node")).alias("last")
        found = sums.select("*", *before, last).where(
            "weight_before < need and (weight_before + weight >= need or bucket = last)"
        )
        for r in found.collect():
            cut = open_[r["node"]]
            cut.before = [cut.before[0] + r["weight_before"], cut.before[1] + r["n_before"]]
            cut.at, cut.values = [r["weight"], r["n"]], r["values"]
            cut.lo, cut.hi = cut.lo + r["bucket"] * cut.step, min(cut.hi, cut.lo + (r["bucket"] + 1) * cut.step - 1)
            if cut.step == 1:
                del open_[r["node"]]
            else:
                cut.narrow()


def _key(dimension: Column) -> Column:
    """A point's place in a dimension, texts of one value in the order of checksums."""
    value = F.get(F.array(*_DIMENSIONS), dimension)
    return F.shiftleft(value, 32).bitwiseOR(F.col("text_crc32"))


def _place() -> Column:
    """A row's place among the copies of its text: by a hash of the id, then of the row."""
    bits = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 31))
    return F.shiftleft(bits("doc_id"), 31).bitwiseOR(bits("row"))


def _split(points: DataFrame, rows: DataFrame, nodes: dict[int, dict], heavy: float) -> tuple[DataFrame, dict]:
    """Points with nodes 2n and 2n + 1 in place of each given node n, and the sides'
    bytes and rows.

    ``nodes`` holds each node's dimension, range, bytes, rows, texts and wanted bytes.
    """
    spark = points.sparkSession
    dimensions = _literals(spark, [(n, x["dimension"]) for n, x in nodes.items()], "node int, dimension int")
    keyed = points.join(dimensions, "node").withColumn("key", _key(F.col("dimension")))
    cuts = {n: _Cut(x["lo"] << 32, (x["hi"] << 32) + (1 << 32) - 1, x["need"], x["points"]) for n, x in nodes.items()}
    _search(keyed.select("node", "key", "weight", "n"), cuts)
    sides, divided = {}, {}
    for node, cut in cuts.items():
        whole, rest = nodes[node]["whole"], cut.need - cut.before[0]
        if cut.at[0] > heavy and 0 < rest < cut.at[0] and cut.at[1] > 1:
            divided[node] = _Cut(0, _PLACES - 1, rest, cut.at[1])
        left = cut.goes_left(whole)
        sides[node] = [b + a * left for b, a in zip(cut.before, cut.at)]
    if divided:
        wanted = _literals(spark, [(n, cuts[n].lo) for n in divided], "node int, cut bigint")
        ends = keyed.join(wanted, "node").where("key = cut").select(*_POINT, "node", "first", "end")
        copies = (
            rows.select(*_POINT, _place().alias("key"), F.col("size").alias("weight"), F.lit(1).cast("bigint").alias("n"))
            .join(if_small(keep(ends, "heavy-points")), _POINT)
            .where("key >= first and key < end")
        )
        _search(copies.select("node", "key", "weight", "n"), divided)
    for node, cut in divided.items():
        left = cut.goes_left(cuts[node].at)
        sides[node] = [b + c + a * left for b, c, a in zip(cuts[node].before, cut.before, cut.at)]
        cut.hi = cut.lo + left  # places before this are on the left
    literals = []
    for node, cut in cuts.items():
        own = divided.get(node)
        part = [s - b for s, b in zip(sides[node], cut.before)]
        place = own.hi if own else _PLACES if part[1] else 0
        literals.append((node, nodes[node]["dimension"], cut.lo, place, own is not None))
    ddl = "split int, dimension int, cut bigint, place bigint, divided boolean"
    out = points.join(_literals(spark, literals, ddl), points["node"] == F.col("split"), "left")
    key = _key(F.col("dimension"))
    part = lambda node, first, end: F.struct(
        node.cast("int").alias("node"), first.alias("first"), end.alias("end")
    )
    first, end, place = F.col("first"), F.col("end"), F.col("place")
    left, right = F.col("node") * 2, F.col("node") * 2 + 1
    parts = (
        F.when(F.col("split").isNull(), F.array(part(F.col("node"), first, end)))
        .when(key < F.col("cut"), F.array(part(left, first, end)))
        .when(key > F.col("cut"), F.array(part(right, first, end)))
        .otherwise(
            F.filter(
                F.array(part(left, first, F.least(end, place)), part(right, F.greatest(first, place), end)),
                lambda p: p["first"] < p["end"],
            )
        )
    )
    new = out.select(*_POINT, *_DIMENSIONS, "weight", "n", (F.col("divided") & (key == F.col("cut"))).alias("cut_now"), F.inline(parts))
    if divided:
        # Bytes and rows of the parts of divided texts, summed over their rows.
        new = keep(new, "cut-points")
        pieces = new.where("cut_now").select(*_POINT, "node", "first", "end")
        sums = (
            rows.select(*_POINT, _place().alias("place")).join(if_small(keep(pieces, "pieces")), _POINT)
            .where("place >= first and place < end")
            .groupBy(*_POINT, "node").agg(F.sum("size").alias("piece"), F.count(F.lit(1)).alias("held"))
        )
        new = new.join(if_small(keep(sums, "pieces")), [*_POINT, "node"], "left")
        now = lambda c, of: F.when(F.col("cut_now"), F.coalesce(of, F.lit(0))).otherwise(F.col(c)).alias(c)
        new = new.select(
            *_POINT, *_DIMENSIONS, now("weight", "piece"), now("n", "held"), "node", "first", "end"
        ).where("n > 0")
    bytes_of = {}
    for node, (size, n) in sides.items():
        whole = nodes[node]["whole"]
        bytes_of[2 * node], bytes_of[2 * node + 1] = [size, n], [whole[0] - size, whole[1] - n]
    return keep(new.drop("cut_now"), "points"), bytes_of


def _shared(k: int, left: Sequence[int], right: Sequence[int]) -> int:
    """How many of k shards the left side gets: by bytes, no more than it has rows."""
    by_bytes = round(k * left[0] / (left[0] + right[0]))
    return max(1, k - right[1], min(by_bytes, k - 1, left[1]))


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, text_hash, row and shard of every row.

    Give the number of ``shards``, or ``target_bytes`` of one. A row's size is its
    text's UTF-8 bytes (null: none) plus 1. Dimensions are the characters of the
    text, and codes of source and language (the least of a text's copies; hashes,
    as their values have no order); a width counts relative to the whole table's,
    a tie goes to the first. No shard is empty while there are as many rows. Copies
    stay together unless they are heavy; ``row`` tells repeated rows apart, which may
    be divided like other copies. An empty table gives no rows.
    """
    spark = docs.sparkSession
    code = lambda c: F.pmod(F.crc32(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(1 << 16))
    text = F.coalesce("text", F.lit(""))
    rows = keep(
        docs.select(
            F.col("doc_id").cast("bigint"), (F.octet_length(text).cast("bigint") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), text_hash(text),
            F.length(text).cast("bigint").alias("n_chars"), code("source").alias("source_code"),
            code("lang").alias("lang_code"), F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    points = rows.groupBy(*_POINT).agg(
        *[F.min(d).alias(d) for d in _DIMENSIONS], F.sum("size").alias("weight"), F.count(F.lit(1)).alias("n")
    )
    whole_range = {"first": F.lit(0).cast("bigint"), "end": F.lit(_PLACES)}
    points = keep(points.withColumns({"node": F.lit(1), **whole_range}), "points")
    leaves, whole, heavy = {1: 1}, None, 0.0
    while True:
        spans = [F.struct(F.min(d).alias("lo"), F.max(d).alias("hi")).alias(d) for d in _DIMENSIONS]
        split = _literals(spark, [(n,) for n, k in leaves.items() if k > 1 or whole is None], "node int")
        stats = points.join(split, "node").groupBy("node").agg(
            F.sum("weight").alias("weight"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("points"), *spans
        ).collect()
        if not stats:
            break
        if whole is None:
            whole = stats[0]
            leaves[1] = min(shards or max(1, -(-int(whole["weight"]) // target_bytes)), whole["n"])
            heavy = HEAVY * whole["weight"] / leaves[1]
        nodes = {}
        for node in stats:
            k = leaves[node["node"]]
            width = [(node[d]["hi"] - node[d]["lo"]) / max(1, whole[d]["hi"] - whole[d]["lo"]) for d in _DIMENSIONS]
            widest = width.index(max(width))
            span = node[_DIMENSIONS[widest]]
            nodes[node["node"]] = {
                "dimension": widest, "lo": span["lo"], "hi": span["hi"], "points": node["points"],
                "whole": [node["weight"], node["n"]], "need": node["weight"] * (k // 2) / k,
            }
        nodes = {n: x for n, x in nodes.items() if leaves[n] > 1}
        if not nodes:
            break
        points, sides = _split(points, rows, nodes, heavy)
        for node in nodes:
            k, left, right = leaves.pop(node), sides[2 * node], sides[2 * node + 1]
            leaves[2 * node] = _shared(k, left, right)
            leaves[2 * node + 1] = k - leaves[2 * node]
        if all(k == 1 for k in leaves.values()):
            break
    # Leaves from left to right: a node's place is its path below the root.
    depth = max(n.bit_length() for n in leaves)
    order = sorted(leaves, key=lambda n: n << (depth - n.bit_length()))
    named = _literals(spark, [(n, i) for i, n in enumerate(order)], "node int, shard int")
    points = points.join(named, "node").select(*_POINT, "first", "end", "shard")
    return (
        rows.withColumn("place", _place()).join(points, _POINT)
        .where("place >= first and place < end")
        .select("doc_id", *_POINT, "row", "shard")
    )


def with_slots(sharded: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0 without a gap, in chunks of bounded size.

    Chunks are by a hash of id, text and row, so that repeated rows spread as well.
    """
    chunks = max(1, sharded.count() // CHUNK_ROWS)
    chunk = F.pmod(F.xxhash64("doc_id", "text_hash", "row"), F.lit(chunks))
    rows = sharded.withColumn("chunk", chunk)
    counts = rows.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n")
    counts = if_small(keep(counts.select("shard", "chunk", ahead.alias("ahead")), "chunk-counts"))
    within = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_hash", "row"))
    numbered = rows.withColumn("within", within).join(counts, ["shard", "chunk"])
    return numbered.withColumn("slot", F.col("ahead") + F.col("within") - 1).drop("chunk", "within", "ahead")


def op4_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes; see ``kd_shards`` for all cases."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return with_slots(keep(kd_shards(docs, shards=SHARDS), "shards")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
