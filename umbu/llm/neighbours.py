"""Approximate nearest neighbours by NN-descent and greedy graph search.

Vectors of one direction are one node. The neighbour graph begins with exact neighbours inside
the leaves of a few random-projection trees, which are grown on a bounded sample.
Every round joins neighbours of neighbours: for each node its neighbours and some of
the nodes it is a neighbour of are compared with each other, and each keeps the
nearest it has met, until a round changes few lists. An entry of a list is marked as
fresh until it has taken part in a round: two nodes are compared only if one of them is
fresh, and neighbours that a node has already are not sent to it again. Nodes of one
leaf are handled together, so that a vector they all need is sent once. A query starts from its node's neighbours and opens the
nearest nodes of its pool until they are all open.

Vectors travel and are compared in double precision, since near copies differ by less
than a shorter one can tell. Of what a query met, all that may be among the nearest
within the error of a product are scored again.
"""

from __future__ import annotations

import functools
import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from umbu.llm.tables import about, keep, table
from umbu.sources.shared import scratch_folder

NEIGHBOURS = 48
TREES = 8
LEAF = 1024
# Rounds end when so small a share of all list entries is new.
SETTLED = 0.001
POOL = 40
# Trees are grown on so many vectors, with so many at least on either side.
SAMPLE, SAMPLE_LEAF = 16_384, 16
PART_NODES, QUERY_BLOCK = 1024, 256
# A task that compares lists thins out the pairs it has met after so many.
HELD_PAIRS = 2_000_000

_LOG = logging.getLogger(__name__)
_STATE = (
    "node bigint, part int, block bigint, vec binary, near binary, sims binary, fresh binary,"
    " least double, changed int"
)


class Forest:
    """Random-projection trees: directions and thresholds of all inner nodes."""

    def __init__(self, sample: np.ndarray, nodes: int, seed: int = 7):
        random = np.random.default_rng(seed)
        self.depth, self.trees = 0, []
        while nodes > LEAF << self.depth and len(sample) >> (self.depth + 1) >= SAMPLE_LEAF:
            self.depth += 1
        for _ in range(TREES if nodes > LEAF else 1):
            directions = np.zeros((1 << self.depth, sample.shape[1] if len(sample) else 0))
            cuts = np.zeros(1 << self.depth)
            at = np.ones(len(sample), dtype=np.int64)
            for node in range(1, 1 << self.depth):
                mine = np.flatnonzero(at == node)
                a, b = sample[random.choice(mine, 2)] if len(mine) else (0, 0)
                directions[node] = a - b
                along = sample[mine] @ directions[node]
                cuts[node] = np.median(along) if len(mine) else 0
                at[mine] = 2 * node + (along > cuts[node])
            self.trees.append((directions, cuts))

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = []
        for number, (directions, cuts) in enumerate(self.trees):
            at = np.ones(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + ((x * directions[at]).sum(axis=1) > cuts[at])
            out.append(at * len(self.trees) + number)
        return np.stack(out, axis=1)


def _matrix(blobs: pa.Array) -> np.ndarray:
    rows = [np.frombuffer(b, np.float64) for b in blobs.to_pylist()]
    return np.stack(rows) if rows else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _chosen(v: np.ndarray, w: np.ndarray, s: np.ndarray, k: int) -> np.ndarray:
    """Places of the k nearest different w of each v; by v, then nearest first.

    Of entries with the same v and w the first one counts.
    """
    order = np.lexsort((w, v))
    fresh = np.append(True, (np.diff(v[order]) != 0) | (np.diff(w[order]) != 0))[: len(v)]
    order = order[fresh]
    order = order[np.lexsort((w[order], -s[order], v[order]))]
    head = np.flatnonzero(np.append(True, np.diff(v[order]) != 0)[: len(order)])
    place = np.arange(len(order)) - np.repeat(head, np.diff(np.append(head, len(order))))
    return order[place < k]


def _part(nodes: np.ndarray, parts: int) -> np.ndarray:
    """The part of the nodes that is merged in one group."""
    return ((_mixed(nodes) >> np.uint64(20)) % np.uint64(parts)).astype(np.int32)


def _mixed(w: np.ndarray) -> np.ndarray:
    return (w.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)


def _lists(nodes: np.ndarray, v: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
    """For each of the nodes its entries' values as bytes; v is sorted like the nodes."""
    order = np.argsort(nodes)
    bounds = np.empty((2, len(nodes)), dtype=np.int64)
    bounds[0, order] = np.searchsorted(v, nodes[order], side="left")
    bounds[1, order] = np.searchsorted(v, nodes[order], side="right")
    return [pa.array([x[a:b].tobytes() for a, b in bounds.T], pa.binary()) for x in values]


def _joined(blobs: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Values of all blobs in a row, and how many each has."""
    each = [np.frombuffer(b, kind) for b in blobs.to_pylist()]
    return np.concatenate([*each, np.zeros(0, kind)]), np.array([len(x) for x in each], dtype=np.int64)


def _entries(table_, first: str, *names: str) -> tuple[np.ndarray, ...]:
    """Nodes and values of all entries of a table of lists."""
    kinds = {"near": np.int64, "sims": np.float64, "fresh": np.bool_}
    values = [_joined(table_.column(n), kinds[n]) for n in names]
    counts = values[0][1] if names else np.zeros(0, np.int64)
    return np.repeat(table_.column(first).to_numpy(), counts).astype(np.int64), *[x for x, _ in values]


_FOUND = "part int, v binary, w binary, s binary"


def _found(v, w, s, parts: int) -> pa.Table:
    """Nodes, what was found near them and how near: one row for each part of nodes."""
    part = _part(v, parts)
    order = np.argsort(part, kind="stable")
    held, heads = np.unique(part[order], return_index=True)
    ends = np.append(heads, len(v))[1:]
    cut = lambda x, kind: pa.array([x[order[a:b]].astype(kind).tobytes() for a, b in zip(heads, ends)], pa.binary())
    return pa.table(
        {"part": pa.array(held, pa.int32()), "v": cut(v, np.int64), "w": cut(w, np.int64), "s": cut(s, np.float64)}
    )


def _halved(x: np.ndarray, most: int, random: np.random.Generator) -> list[np.ndarray]:
    """Rows of a leaf in parts of at most ``most``, by further random projections."""
    todo, out = [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            out.append(rows)
            continue
        a, b = x[random.choice(rows, 2, replace=False)]
        order = np.argpartition(x[rows] @ (a - b), len(rows) // 2)
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return out


def _leaf_neighbours(leaf: int, parts: int):
    """Exact neighbours inside a leaf.

    What the sample could not divide is divided here, in each tree in its own way.
    """

    def run(key, group):
        group = group.sort_by("node")
        every = group.column("node").to_numpy()
        vectors = _matrix(group.column("vec"))
        v, w, s = [], [], []
        for part in _halved(vectors, 2 * leaf, np.random.default_rng(key[0].as_py())):
            ids, x = every[part], vectors[part]
            k = min(NEIGHBOURS // 2, len(ids) - 1)
            for at in range(0, len(ids) if k else 0, 256):
                sims = x[at : at + 256] @ x.T
                rows = np.arange(len(sims))
                sims[rows, at + rows] = -2
                top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                v.append(np.repeat(ids[at : at + 256], k))
                w.append(ids[top].ravel())
                s.append(np.take_along_axis(sims, top, axis=1).ravel())
        v, w, s = (np.concatenate([*x, np.zeros(0, t)]) for x, t in ((v, np.int64), (w, np.int64), (s, float)))
        best = _chosen(v, w, s, NEIGHBOURS)
        return _found(v[best], w[best], s[best], parts)

    return run


def _merged(state, found):
    """Nodes of a part with the nearest of what they had and what was found.

    What they had has taken part in the round; what is new in a list is fresh.
    """
    nodes = state.column("node").to_numpy()
    old = _entries(state, "node", "near", "sims")
    new = [_joined(found.column(c), kind)[0] for c, kind in (("v", np.int64), ("w", np.int64), ("s", np.float64))]
    v, w, s = (np.concatenate(x) for x in zip(old, new))
    best = _chosen(v, w, s, NEIGHBOURS)
    v, w, s, fresh = v[best], w[best], s[best], best >= len(old[0])
    near, sims, marks = _lists(nodes, v, w, s, fresh)
    least = [np.frombuffer(x, np.float64)[-1] if len(x) == 8 * NEIGHBOURS else -2.0 for x in sims.to_pylist()]
    changed = [int(np.frombuffer(x, np.bool_).sum()) for x in marks.to_pylist()]
    return pa.table(
        {
            **{n: state.column(n) for n in ("node", "part", "block", "vec")},
            "near": near, "sims": sims, "fresh": marks,
            "least": pa.array(least, pa.float64()), "changed": pa.array(changed, pa.int32()),
        }
    )


def _preferred(v: np.ndarray, w: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Which reverse edges take part, if a node has many: fresh ones, then any."""
    return fresh * float(1 << 60) - _mixed(v + w).astype(np.float64)


def _reverse(batches, parts: int):
    """Edges turned round; a task passes on at most ``NEIGHBOURS`` of a node's."""
    for batch in batches:
        w, v, fresh = _entries(batch, "node", "near", "fresh")
        best = _chosen(v, w, _preferred(v, w, fresh), NEIGHBOURS)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(_part(v[best], parts)), "node": pa.array(v[best]), "other": pa.array(w[best]),
                "fresh": pa.array(fresh[best]),
            }
        )


def _members(state, reverse):
    """For each node of a part: itself, its neighbours, and some it is one of.

    Nodes without a fresh one have nothing to compare.
    """
    nodes, block = (state.column(n).to_numpy() for n in ("node", "block"))
    v, w, fresh = _entries(state, "node", "near", "fresh")
    rv, rw, rf = (reverse.column(n).to_numpy(zero_copy_only=False) for n in ("node", "other", "fresh"))
    best = _chosen(rv, rw, _preferred(rv, rw, rf.astype(bool)), NEIGHBOURS)
    v, w = np.concatenate([v, rv[best], nodes]), np.concatenate([w, rw[best], nodes])
    fresh = np.concatenate([fresh, rf[best].astype(bool), np.zeros(len(nodes), bool)])
    best = _chosen(v, w, fresh.astype(float), 2 * NEIGHBOURS + 1)
    v, w, fresh = v[best], w[best], fresh[best]
    some = np.isin(nodes, np.unique(v[fresh]))
    near, marks = _lists(nodes[some], v, w, fresh)
    return pa.table(
        {"block": pa.array(block[some], pa.int64()), "node": pa.array(nodes[some], pa.int64()), "near": near, "fresh": marks}
    )


_NEEDED = "block bigint, part int, ids binary"


def _needed(key, group, parts: int):
    """The different members of all lists of a block, by the part they are in."""
    ids = np.unique(_joined(group.column("near"), np.int64)[0])
    part = _part(ids, parts)
    held = np.unique(part)
    return pa.table(
        {
            "block": pa.array(np.full(len(held), key[0].as_py()), pa.int64()), "part": pa.array(held, pa.int32()),
            "ids": pa.array([ids[part == p].tobytes() for p in held], pa.binary()),
        }
    )


_SENT = "block bigint, ids binary, vecs binary, least binary, near binary, counts binary"


def _sent(state, needed):
    """What each block needs to know of the nodes of a part, in one row for the block."""
    nodes = state.column("node").to_numpy()
    order = np.argsort(nodes)
    vecs, least = _matrix(state.column("vec")), state.column("least").to_numpy()
    near = [np.frombuffer(b, np.int64) for b in state.column("near").to_pylist()]
    out = [[] for _ in range(5)]
    for blob in needed.column("ids").to_pylist():
        at = order[np.searchsorted(nodes, np.frombuffer(blob, np.int64), sorter=order)]
        counts = np.array([len(near[i]) for i in at], dtype=np.int64)
        known = np.concatenate([near[i] for i in at])
        for column, x in zip(out, (nodes[at], vecs[at], least[at], known, counts)):
            column.append(x.tobytes())
    names = ("ids", "vecs", "least", "near", "counts")
    return pa.table({"block": needed.column("block"), **{n: pa.array(c, pa.binary()) for n, c in zip(names, out)}})


def _local_join(lists, vectors, parts: int):
    """Compare fresh members of every list with all of it; each node keeps what beats
    its worst neighbour and is none of its neighbours yet."""
    kinds = {"ids": np.int64, "vecs": np.float64, "least": np.float64, "near": np.int64, "counts": np.int64}
    ids, x, least, theirs, counts = (_joined(vectors.column(n), kind)[0] for n, kind in kinds.items())
    mine, order = np.repeat(ids, counts), np.argsort(ids)
    ids, x, least = ids[order], x.reshape(len(ids), -1)[order] if len(ids) else x.reshape(0, 1), least[order]
    at = np.minimum(np.searchsorted(ids, theirs), len(ids) - 1)
    here = ids[at] == theirs
    known = np.unique(np.searchsorted(ids, mine[here]) * len(ids) + at[here])
    found, held = [], 0

    def kept(found):
        v, w, s = (np.concatenate([*c, np.zeros(0, t)]) for c, t in zip(zip(*found), (np.int64, np.int64, float)))
        pair = v * len(ids) + w
        new = known[np.minimum(np.searchsorted(known, pair), len(known) - 1)] != pair if len(known) else np.ones(len(pair), bool)
        v, w, s = v[new], w[new], s[new]
        best = _chosen(v, w, s, NEIGHBOURS)
        return [(v[best], w[best], s[best])]

    for blob, marks in zip(lists.column("near").to_pylist(), lists.column("fresh").to_pylist()):
        at, fresh = np.searchsorted(ids, np.frombuffer(blob, np.int64)), np.flatnonzero(np.frombuffer(marks, np.bool_))
        sims = x[at[fresh]] @ x[at].T
        sims[np.arange(len(fresh)), fresh] = -3
        a, b = np.nonzero(sims > least[at[fresh]][:, None])
        c, d = np.nonzero(sims > least[at])
        found.append((at[fresh[a]], at[b], sims[a, b]))
        found.append((at[d], at[fresh[c]], sims[c, d]))
        held += len(a) + len(c)
        if held > HELD_PAIRS:
            found, held = kept(found), 0
    if not found:
        return _found(*[np.zeros(0, np.int64)] * 3, parts)
    ((v, w, s),) = kept(found)
    return _found(ids[v], ids[w], s, parts)


def direction(vector: str | Column = "embedding") -> Column:
    """An array of doubles over its largest absolute component; 0 has one sign.

    A zero vector gives nulls.
    """
    largest = F.array_max(F.transform(vector, F.abs))
    return F.transform(vector, lambda x: F.try_divide(x, largest) + F.lit(0.0))


def prepare(vectors: DataFrame, results: int) -> DataFrame:
    """One row per different direction that can be compared, with its smallest ids.

    ``embedding`` is divided by its largest component: quotients are rounded from the
    exact ones, so that vectors which are exact multiples are equal then.

    Null, zero and empty vectors, those with null or non-finite components, those
    of another length than most, and rows without vec_id take no part.
    """
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>")).where(
        "vec_id is not null and size(embedding) > 0"
    )
    rows = rows.where(good).where(F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("embedding") == F.lit(sizes["n"] if sizes else 0))
    rows = rows.withColumn("embedding", direction())
    few = lambda ids: F.slice(F.array_sort(ids), 1, results + 1)
    salted = rows.groupBy("embedding", F.pmod(F.xxhash64("vec_id"), F.lit(256)).alias("salt"))
    grouped = salted.agg(few(F.collect_list("vec_id")).alias("ids")).groupBy("embedding")
    grouped = grouped.agg(few(F.flatten(F.collect_list("ids"))).alias("ids"))
    return keep(grouped.withColumn("node", F.monotonically_increasing_id()), "vectors")


def build_graph(nodes: DataFrame) -> DataFrame:
    """Neighbour graph: each node's vector, nearest nodes and their similarities.

    Lists only get nearer, so the rounds end.
    """
    spark = nodes.sparkSession
    count = nodes.count()
    held = [r["embedding"] for r in about(nodes.select("embedding"), SAMPLE, count, "embedding").collect()]
    forest = spark.sparkContext.broadcast(Forest(_unit(np.array(held)) if held else np.zeros((0, 1)), count))
    parts = max(1, -(-count // PART_NODES))
    # Blocks only say which lists are compared in one task, so large ones may be cut by hash.
    salts = max(1, -(-count // (LEAF << forest.value.depth)))

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            x = _unit(np.stack([np.array(v) for v in batch.column(1).to_pylist()]))
            leaves = forest.value.leaves(x)
            none = pa.array([b""] * len(ids), pa.binary())
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array(ids), "part": pa.array(_part(ids, parts)),
                    "block": pa.array(leaves[:, 0] * salts + ids % salts), "vec": pa.array([r.tobytes() for r in x], pa.binary()),
                    "near": none, "sims": none, "fresh": none, "least": pa.array(np.full(len(ids), -2.0)),
                    "changed": pa.array(np.zeros(len(ids), np.int32)),
                    "leaves": pa.array(list(leaves), pa.list_(pa.int64())),
                }
            )

    state = keep(nodes.select("node", "embedding").mapInArrow(place, _STATE + ", leaves array<bigint>"), "placed")
    leaf = state.select("node", "vec", F.explode("leaves").alias("leaf"))
    found = leaf.groupBy("leaf").applyInArrow(_leaf_neighbours(LEAF, parts), _FOUND)
    # A round writes its graph over the last but one, and its lists over the last.
    graphs, place_of_lists = [scratch_folder(spark, "graph") for _ in range(2)], scratch_folder(spark, "lists")
    state, rounds = _merge(state.drop("leaves"), found, graphs[0]), 0
    changed = count * NEIGHBOURS
    while changed > SETTLED * count * NEIGHBOURS:
        turned = state.select("node", "near", "fresh").mapInArrow(
            functools.partial(_reverse, parts=parts), "part int, node bigint, other bigint, fresh boolean"
        )
        lists = state.groupBy("part").cogroup(turned.groupBy("part")).applyInArrow(
            _members, "block bigint, node bigint, near binary, fresh binary"
        )
        lists = keep(lists, "lists", place_of_lists)
        wanted, join = functools.partial(_needed, parts=parts), functools.partial(_local_join, parts=parts)
        needed = lists.groupBy("block").applyInArrow(lambda key, group: wanted(key, group), _NEEDED)
        sent = state.select("part", "node", "vec", "near", "least").groupBy("part")
        sent = sent.cogroup(needed.groupBy("part")).applyInArrow(_sent, _SENT)
        found = lists.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(
            lambda lists, vectors: join(lists, vectors), _FOUND
        )
        seen = Observation()
        rounds += 1
        found = found.observe(seen, F.sum(F.octet_length("w") / 8).alias("entries"))
        state = _merge(state, found, graphs[rounds % 2])
        changed = state.agg(F.sum("changed")).first()[0] or 0
        _LOG.info("round %d: %d entries sent, %d new to a list", rounds, seen.get["entries"] or 0, changed)
    return state


def _merge(state: DataFrame, found: DataFrame, place: str) -> DataFrame:
    merged = state.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(_merged, _STATE)
    return keep(merged, "graph", place)


_POOLS = "node bigint, block int, vec binary, near binary, sims binary, open binary"


def _frontier(batches):
    """The nodes each query opens next: the nearest of its pool not opened yet."""
    for batch in batches:
        block, query, near, sims, opened = batch.columns
        w = [np.frombuffer(b, np.int64) for b in near.to_pylist()]
        o = [np.frombuffer(b, np.bool_) for b in opened.to_pylist()]
        todo = [a[:POOL][~b[:POOL]] for a, b in zip(w, o)]
        n = [len(t) for t in todo]
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array(np.repeat(block.to_numpy(), n)), "query": pa.array(np.repeat(query.to_numpy(), n)),
                "node": pa.array(np.concatenate(todo or [np.zeros(0, np.int64)])),
            }
        )


def _wanted(key, group):
    lists = [np.frombuffer(b, np.int64) for b in group.column("near").to_pylist()]
    ids = np.unique(np.concatenate(lists))
    return pa.table({"block": pa.array(np.full(len(ids), key[0].as_py()), pa.int32()), "node": pa.array(ids, pa.int64())})


def _widened(pools, met):
    """Pools of a block of queries with the neighbours of what they opened."""
    is_vector = ~np.array(met.column("vec").is_null())
    vectors = met.filter(pa.array(is_vector))
    ids = vectors.column("node").to_numpy()
    order = np.argsort(ids)
    ids, x = ids[order], _matrix(vectors.column("vec"))[order] if len(ids) else np.zeros((0, 1))
    lists = met.filter(pa.array(~is_vector))
    reached: dict[int, list[np.ndarray]] = {}
    for query, near in zip(lists.column("query").to_pylist(), lists.column("near").to_pylist()):
        reached.setdefault(query, []).append(np.frombuffer(near, np.int64))
    near_out, sims_out, open_out = [], [], []
    own = _matrix(pools.column("vec"))
    for i, (query, near, sims, opened) in enumerate(
        zip(*[pools.column(n).to_pylist() for n in ("node", "near", "sims", "open")])
    ):
        w, s = np.frombuffer(near, np.int64), np.frombuffer(sims, np.float64)
        o = np.frombuffer(opened, np.bool_).copy()
        o[:POOL] = True
        fresh = np.setdiff1d(np.concatenate(reached.get(query, [np.zeros(0, np.int64)])), np.append(w, query))
        if len(fresh):
            new = x[np.searchsorted(ids, fresh)] @ own[i]
            w, s = np.append(w, fresh), np.append(s, new)
            o = np.append(o, np.zeros(len(fresh), bool))
            order = np.lexsort((w, -s))
            w, s, o = w[order], s[order], o[order]
        near_out.append(w.tobytes())
        sims_out.append(s.tobytes())
        open_out.append(o.tobytes())
    return pa.table(
        {
            **{n: pools.column(n) for n in ("node", "block", "vec")},
            "near": pa.array(near_out, pa.binary()), "sims": pa.array(sims_out, pa.binary()),
            "open": pa.array(open_out, pa.binary()),
        }
    )


def greedy_search(graph: DataFrame, queries: DataFrame) -> DataFrame:
    """Pools of the query nodes (column node): what a greedy search met, nearest first.

    It ends when every pool's nearest ``POOL`` are open; no node is opened twice.
    """
    spark = graph.sparkSession
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block")
    shut = F.expr("unhex(repeat('00', cast(octet_length(near) / 8 as int)))").alias("open")
    pools = graph.join(queries.select("node"), "node", "left_semi").select("node", block, "vec", "near", "sims", shut)
    places, place_of_opened = [scratch_folder(spark, "pools") for _ in range(2)], scratch_folder(spark, "opened")
    pools, steps = keep(pools, "pools", places[0]), 0
    while True:
        front = pools.select("block", F.col("node").alias("query"), "near", "sims", "open")
        front = front.mapInArrow(_frontier, "block int, query bigint, node bigint")
        lists = front.join(graph.select("node", "near"), "node").select("block", "query", "near")
        lists = keep(lists, "opened", place_of_opened)
        if not lists.limit(1).count():
            break
        wanted = lists.groupBy("block").applyInArrow(_wanted, "block int, node bigint")
        vectors = wanted.join(graph.select("node", "vec"), "node")
        none = lambda kind: F.lit(None).cast(kind)
        met = lists.select("block", "query", none("bigint").alias("node"), "near", none("binary").alias("vec")).unionByName(
            vectors.select("block", none("bigint").alias("query"), "node", none("binary").alias("near"), "vec")
        )
        pools = pools.groupBy("block").cogroup(met.groupBy("block")).applyInArrow(_widened, _POOLS)
        steps += 1
        pools = keep(pools, "pools", places[steps % 2])
    return pools


def _nearest(n: int):
    """Of each pool the n nearest, and all others that may be as near."""

    def run(batches):
        for batch in batches:
            query, vec, near, sims = batch.columns
            w = []
            for own, a, b in zip(vec.to_pylist(), near.to_pylist(), sims.to_pylist()):
                s = np.frombuffer(b, np.float64)
                # Products of unit vectors, here and in the score, are wrong by less than that.
                error = (len(own) // 8 + 8) * 4 * np.finfo(np.float64).eps
                w.append(np.frombuffer(a, np.int64)[s >= s[min(n, len(s)) - 1] - error] if len(s) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "query_node": pa.array(np.repeat(query.to_numpy(), [len(x) for x in w])),
                    "node": pa.array(np.concatenate(w or [np.zeros(0, np.int64)])),
                }
            )

    return run


def cosine(a: str, b: str) -> Column:
    """Cosine of two arrays of doubles, in double precision."""
    sum_ = lambda x: F.aggregate(x, F.lit(0.0), lambda t, v: t + v)
    norm = lambda c: F.sqrt(sum_(F.transform(c, lambda v: v * v)))
    return sum_(F.zip_with(a, b, lambda x, y: x * y)) / (norm(a) * norm(b))


def search(vectors: DataFrame, queries: DataFrame, results: int) -> DataFrame:
    """The ``results`` nearest vectors found for each query row, by cosine.

    ``queries`` are rows of ``vectors``. Candidates are all other rows that can be
    compared (see ``prepare``); ties go to the smaller vec_id. Queries that cannot
    be compared have no rows. Vectors of one direction are found together:
    of each, the smallest ids are enough. An empty table gives no rows.
    """
    nodes = prepare(vectors, results)
    graph = build_graph(nodes)
    asked = queries.select(
        F.col("vec_id").cast("bigint").alias("query_id"), direction(F.col("embedding").cast("array<double>")).alias("embedding")
    )
    asked = asked.join(nodes.select("embedding", "node"), "embedding").select("query_id", F.col("node").alias("query_node"))
    asked = keep(asked.where("query_id is not null"), "queries")
    pools = greedy_search(graph, asked.select(F.col("query_node").alias("node")).distinct())
    pairs = pools.select("node", "vec", "near", "sims").mapInArrow(_nearest(results), "query_node bigint, node bigint")
    pairs = pairs.union(pools.select("node", "node"))
    near = pairs.join(nodes, "node").select("query_node", "ids", F.col("embedding").alias("theirs"))
    own = nodes.select(F.col("node").alias("query_node"), F.col("embedding").alias("own"))
    scored = near.join(own, "query_node").select("query_node", "ids", cosine("own", "theirs").alias("score"))
    rows = scored.join(asked, "query_node").select("query_id", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        rows.where("vec_id <> query_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= results)
        .select("query_id", "rank", "vec_id", "score")
    )


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, vectors.where("vec_id % 50 = 0"), 5)
