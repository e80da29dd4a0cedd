"""Line deduplication by an exact set-similarity join.

A line is the set of its lower-cased words. Two lines are alike if the Jaccard
similarity of their sets is at least the threshold. A line is removed if an
earlier one is like it: earlier by doc_id (rows without one come last), then by
line number. So the first line of equal lines stays, unless a different earlier
line is like it.

Words are ordered by rarity, from counts in hashed buckets; any order that is the
same everywhere gives exact results. Two like lines share a word among the first
few of both (the prefix), so lines are joined on prefix words. A pair must pass
the length filter, the positional filter and a bitmap filter (each word flips one
of 128 bits; the bits that differ are no more than the words that differ). What is
left is verified on the lines' words, fetched from the texts, as 64-bit hashes. Equal sets are one row in all of this.

A line only needs one earlier match. So the list of a prefix word yields, for each
of its lines, the earliest line that passes the filters, never all of them: many
variants of a line are not paired with each other. Lines none of whose pairs hold
when verified are compared with all others that pass. A list that may be very long
is cut into cells, by hashes of both lines, that are compared apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umbu.llm.tables import if_small, keep, same, table, text_hash
from umbu.llm.words import NOT_SPACE, mix, pieces, word_hashes, word_places

THRESHOLD = Fraction(4, 5)
# Buckets of the word counts: 2 to this power, so 2 MB, whatever the corpus.
COUNT_BITS = 18
# A list that may have more lines than this is compared in cells.
CELL_LINES = 1 << 17
# Texts are handled in pieces of about this size, whose arrays stay in the cache.
LINE_BYTES = 1 << 17
# Words are counted so many at a time, and counts are sent so many to a row.
COUNT_WORDS = 1 << 20
_RUN = 16
# A part of the lists has about so many postings; a task bundles about so many at a time.
PART_POSTINGS = 1 << 17
BUNDLE_POSTINGS = 1 << 18

_SET = ["sid", "bits", "more_bits", "size"]
_LINES = (
    "doc_id bigint, text_hash bigint, line int, sid bigint, bits bigint, more_bits bigint, size int,"
    " skip int, tokens array<bigint>, n_postings bigint"
)
_NO_ID = (1 << 63) - 1


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


_COUNTS = [f"n{i}" for i in range(_RUN)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << COUNT_BITS, dtype=np.int64)
    held, words = [], 0
    for batch in batches:
        for piece in pieces(batch.column(0), LINE_BYTES):
            held.append(_bucket(word_hashes(piece, *word_places(piece, NOT_SPACE))))
            words += len(held[-1])
            if words >= COUNT_WORDS:
                counts += np.bincount(np.concatenate(held), minlength=len(counts))
                held, words = [], 0
    if words:
        counts += np.bincount(np.concatenate(held), minlength=len(counts))
    runs = counts.reshape(-1, _RUN)
    places = np.flatnonzero(runs.any(axis=1))
    if len(places):
        columns = [pa.array(places), *(pa.array(runs[places, i]) for i in range(_RUN))]
        yield pa.RecordBatch.from_arrays(columns, names=["place", *_COUNTS])


def word_counts(docs: DataFrame) -> np.ndarray:
    """Words of all texts counted in hashed buckets, in tasks, and summed by bucket.

    A row has the counts of some buckets in a row, so that few rows are grouped.
    """
    parts = docs.select("text").mapInArrow(_count, ", ".join(f"{c} bigint" for c in ["place", *_COUNTS]))
    found = parts.groupBy("place").agg(*(F.sum(c).alias(c) for c in _COUNTS)).toArrow()
    out = np.zeros((1 << COUNT_BITS) // _RUN * _RUN, dtype=np.int64).reshape(-1, _RUN)
    for i, c in enumerate(_COUNTS):
        out[found.column("place").to_numpy(), i] = found.column(c).to_numpy()
    return out.ravel()


def _ordered(group: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Order by group, then rank (43 bits)."""
    if len(group) and group[-1] >= 1 << 21:
        return np.lexsort((rank, group))
    return np.argsort((group.astype(np.uint64) << np.uint64(43)) | rank)


def _line_sets(counts, threshold: Fraction):
    num, den = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = counts.value
        level = np.minimum(64 * np.log2(often + 1.0), 2047).astype(np.uint64)
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(1)
            for piece in pieces(batch.column(2), LINE_BYTES):
                starts, ends = word_places(piece, NOT_SPACE)
                if not len(starts):
                    continue
                h = word_hashes(piece, starts, ends)
                breaks = np.flatnonzero(piece.data == 10)
                doc = np.searchsorted(piece.bounds, starts, side="right") - 1
                line = np.searchsorted(breaks, starts)
                group = np.cumsum(np.diff(line + doc, prepend=line[0] + doc[0]) != 0)
                bucket = _bucket(h)
                rank = (level[bucket] << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
                order = _ordered(group, rank)
                h, group = h[order], group[order]
                fresh = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (group[1:] != group[:-1])))
                h, group, order = h[fresh], group[fresh], order[fresh]
                heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
                size = np.diff(np.append(heads, len(h)))
                sid = np.add.reduceat(mix(h ^ np.uint64(0x5851F42D4C957F2D)), heads)
                flip = np.uint64(1) << ((h >> np.uint64(33)) & np.uint64(63))
                upper = flip * ((h >> np.uint64(39)) & np.uint64(1))
                bits = np.bitwise_xor.reduceat(flip ^ upper, heads)
                more_bits = np.bitwise_xor.reduceat(upper, heads)
                prefix = size - (num * size + den - 1) // den + 1
                # Places of the prefixes' words; each set has one at least.
                begins = np.cumsum(prefix) - prefix
                words = np.arange(begins[-1] + prefix[-1]) + np.repeat(heads - begins, prefix)
                times = often[bucket[order[words]]]
                used = times != 1
                cells = 1 + times // CELL_LINES
                tokens = (cells[used] << 32) | (h[words[used]] & np.uint64(0xFFFFFFFF)).astype(np.int64)
                n_postings = np.add.reduceat(np.where(used, 2 * cells - 1, 0), begins)
                n_tokens = np.add.reduceat(used.astype(np.int64), begins)
                bounds = pa.array(np.append(0, np.cumsum(n_tokens)).astype(np.int32))
                first = order[heads]
                number = line[first] - np.searchsorted(breaks, piece.bounds[doc[first]])
                rows = pa.array(piece.first + doc[first])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(rows),
                        hashes.take(rows),
                        pa.array(number.astype(np.int32)),
                        pa.array(sid.view(np.int64)),
                        pa.array(bits.view(np.int64)),
                        pa.array(more_bits.view(np.int64)),
                        pa.array(size.astype(np.int32)),
                        pa.array((prefix - n_tokens).astype(np.int32)),
                        pa.ListArray.from_arrays(bounds, pa.array(tokens)),
                        pa.array(n_postings),
                    ],
                    names=["doc_id", "text_hash", "line", *_SET, "skip", "tokens", "n_postings"],
                )

    return run


def line_sets(docs: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """One row per line that has words: its set's hashes, size and prefix words.

    Words that occur once in the corpus are left out of the prefix; ``skip`` says
    how many, so that places in the order are kept.
    """
    counts = docs.sparkSession.sparkContext.broadcast(word_counts(docs))
    rows = docs.select(F.col("doc_id").cast("bigint"), text_hash(), "text")
    return rows.mapInArrow(_line_sets(counts, threshold), _LINES)


def _alike(threshold: Fraction) -> Column:
    """Whether two rows a, b that share a prefix word can be alike (b is later)."""
    num, den = threshold.numerator, threshold.denominator
    both = F.col("a.size") + F.col("b.size")
    shared = F.expr(f"({num} * (a.size + b.size) + {num + den - 1}) div {num + den}")
    left = F.least(F.col("a.size") - F.col("a.pos"), F.col("b.size") - F.col("b.pos"))
    # The order of lines, which makes rows, is compared last.
    return (
        (F.col("a.size") * den >= F.col("b.size") * num)
        & (F.col("b.size") * den >= F.col("a.size") * num)
        & (left >= shared)
        & (
            F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits")))
            + F.bit_count(F.col("a.more_bits").bitwiseXOR(F.col("b.more_bits")))
            <= both - shared * 2
        )
        & (F.struct("a.doc", "a.line", "a.n") < F.struct("b.doc", "b.line", "b.n"))
    )


# What is sent of a posting: its list and cell as one hash, the set's number and first
# line, its bitmap, and size, place in the order and role in one number. A row has
# postings of one part, its key: of each of these the numbers, one after another.
_POSTING = {
    "list": np.int32, "doc": np.int64, "line": np.int32, "n": np.int64, "bits": np.int64, "more_bits": np.int64,
    "packed": np.int64,
}
_BUNDLE = "key bigint, " + ", ".join(f"{c} binary" for c in _POSTING)
_BOTH, _ONLY_A, _ONLY_B = 0, 1, 2
_FIELD = 31


def _salt() -> Column:
    """Which part of a long list a posting is in."""
    return F.when(F.col("cells") == 1, 0).otherwise(F.pmod(F.xxhash64("n"), F.col("cells")).cast("int"))


def _listed(sets: DataFrame) -> DataFrame:
    """Postings of sets, a row each, with the number of cells of their list."""
    # A word and, in its upper half, the number of cells of its list.
    word = F.posexplode("prefix.tokens").alias("at", "word")
    return sets.select("n", *_SET[1:], "first.doc", "first.line", "prefix.skip", word).select(
        F.expr("word & 4294967295").alias("token"), F.shiftright("word", 32).alias("cells"),
        "n", *_SET[1:], "doc", "line", (F.col("skip") + F.col("at")).alias("pos"),
    )


def _postings(sets: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each posting: the hash of its list and cell, its set's row, and ``packed``.

    Postings of long lists are there once for each cell, as an earlier or a later line:
    cell (i, j) compares later lines of salt i with earlier ones of salt j.
    """
    n, size, skip = (sets.column(c).to_numpy() for c in ("n", "size", "skip"))
    many = pc.list_value_length(sets.column("tokens")).to_numpy().astype(np.int64)
    word = sets.column("tokens").flatten().to_numpy()
    row = np.repeat(np.arange(len(n)), many)
    pos = skip[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    cells = word >> 32
    cell, role = np.zeros(len(word), np.int64), np.full(len(word), _BOTH)
    if (cells > 1).any():
        salt = (mix(n[row].view(np.uint64)) % cells.astype(np.uint64)).astype(np.int64)
        times = 2 * cells - 1
        of = np.repeat(np.arange(len(word)), times)
        other = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
        row, pos, word, cells, salt = row[of], pos[of], word[of], cells[of], salt[of]
        later = other < cells
        other = np.where(later, other, other - cells)
        other += ~later & (other >= salt)
        cell = np.where(later, salt * cells + other, other * cells + salt)
        role = np.where(later, np.where(other == salt, _BOTH, _ONLY_B), _ONLY_A)
    token = (word & 0xFFFFFFFF).astype(np.uint64)
    packed = (((size[row].astype(np.int64) << _FIELD) | pos) << 2) | role
    return mix(mix(token) + cell.astype(np.uint64)), row, packed


def _bundles(parts: int):
    """Postings of sets in bundles: lists whose hashes are equal are one, and verified."""
    of_set = ["doc", "line", "n", "bits", "more_bits"]

    def bundled(held: list[pa.RecordBatch], found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        hashed, row, packed = (np.concatenate(x) for x in zip(*found))
        part = ((hashed >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        order = np.argsort(part.astype(np.uint16 if parts <= 1 << 16 else np.uint32), kind="stable")
        part, row = part[order], row[order]
        heads = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        bounds = np.append(heads, len(part))
        sets = pa.Table.from_batches(held)
        columns = {c: sets.column(c).to_numpy()[row] for c in of_set}
        columns["list"] = (hashed[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
        columns["packed"] = packed[order]
        arrays = []
        for c, kind in _POSTING.items():
            numbers = np.ascontiguousarray(columns[c], dtype=kind)
            places = (bounds * numbers.itemsize).astype(np.int32)
            arrays.append(pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(places), pa.py_buffer(numbers)]))
        return pa.RecordBatch.from_arrays([pa.array(part[heads].astype(np.int64)), *arrays], names=["key", *_POSTING])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found, rows, some = [], [], 0, 0
        for batch in batches:
            made = np.cumsum(batch.column("n_postings").to_numpy())
            first = 0
            while first < batch.num_rows:
                before = made[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(made, before + BUNDLE_POSTINGS, side="right")))
                sets = batch.slice(first, last - first)
                hashed, row, packed = _postings(sets)
                held.append(sets.select(of_set))
                found.append((hashed, row + rows, packed))
                rows += sets.num_rows
                some += len(row)
                first = last
                if some >= BUNDLE_POSTINGS:
                    yield bundled(held, found)
                    held, found, rows, some = [], [], 0, 0
        if some:
            yield bundled(held, found)

    return run


def _by_line(group: np.ndarray, doc: np.ndarray, line: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Order by group (from 0, ascending), then by doc, line and n."""
    low, lines = int(doc.min()), int(line.max()) + 1
    docs = int(doc.max()) - low + 1
    if (int(group[-1]) + 1) * docs * lines < 1 << 63:
        place = (group * docs + (doc - low)) * lines + line
        order = np.argsort(place)
        if (np.diff(place[order]) != 0).all():
            return order
    return np.lexsort((n, line, doc, group))


def _earliest(threshold: Fraction):
    """For the lists of a part: the earliest candidate of each posting."""
    num, den = threshold.numerator, threshold.denominator

    def compare(rows: pa.Table) -> pa.Table:
        listed, doc, line, n, bits, more, packed = (
            np.frombuffer(b"".join(rows.column(c).to_pylist()), kind) for c, kind in _POSTING.items()
        )
        order = np.argsort(listed)
        group = np.cumsum(np.append(False, np.diff(listed[order]) != 0))
        # A posting that is alone in its list has no candidate.
        order = order[np.bincount(group)[group] > 1]
        if not len(order):
            return pa.table({c: pa.array([], t) for c, t in _FOUND.items()})
        group = np.cumsum(np.append(False, np.diff(listed[order]) != 0))
        order = order[_by_line(group, doc[order], line[order], n[order])]
        doc, line, n, bits, more, packed = (x[order] for x in (doc, line, n, bits, more, packed))
        bits, more, packed = (x.view(np.uint64) for x in (bits, more, packed))
        role = packed & np.uint64(3)
        pos = ((packed >> np.uint64(2)) & np.uint64((1 << _FIELD) - 1)).astype(np.int64)
        size = (packed >> np.uint64(2 + _FIELD)).astype(np.int64)
        # Each list by size: of a line's smaller ones those from low to high pass the filters
        # for length and for its own place, and then the one for theirs if bound[j] >= least[i].
        wide = int(size.max()) + 1
        by_size = np.argsort(group * wide + size)
        size, left, base = size[by_size], (size - pos)[by_size], group[by_size] * wide
        least = num * size
        bound = (num + den) * left - least
        low = np.searchsorted(base + size, base + (least + den - 1) // den)
        high = np.searchsorted(base + size, base + bound // num, side="right")
        many = np.minimum(high, np.arange(len(size))) - low
        best = np.full(len(size), len(size))
        cut = (role != _BOTH).any()
        i = np.flatnonzero(many > 0)
        k = 0
        while len(i):
            j = low[i] + k
            good = bound[j] >= least[i]
            x, y = i[good], j[good]
            both = size[x] + size[y]
            most = both - 2 * ((num * both + num + den - 1) // (num + den))
            x, y = by_size[x], by_size[y]
            apart = np.bitwise_count(bits[x] ^ bits[y]).astype(np.int64) + np.bitwise_count(more[x] ^ more[y])
            close = apart <= most
            x, y = x[close], y[close]
            a, b = np.minimum(x, y), np.maximum(x, y)
            if cut:
                met = (role[a] != _ONLY_B) & (role[b] != _ONLY_A)
                a, b = a[met], b[met]
            np.minimum.at(best, b, a)
            k += 1
            i = i[many[i] > k]
        b = np.flatnonzero(best < len(best))
        a = best[b]
        return pa.table([pa.array(x, t) for x, t in zip((doc[a], line[a], n[a], n[b]), _FOUND.values())], names=[*_FOUND])

    return compare


_FOUND = {"a_doc": pa.int64(), "a_line": pa.int32(), "a_n": pa.int64(), "b_n": pa.int64()}


def _line_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different words, as hashes, of the lines that are wanted of each text."""
    for batch in batches:
        numbers, lines = [], []
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parts = text.split("\n")
            numbers += [x["n"] for x in wanted]
            lines += [parts[x["line"]] for x in wanted]
        for piece in pieces(pa.array(lines, pa.string()), LINE_BYTES):
            starts, ends = word_places(piece, NOT_SPACE)
            h = word_hashes(piece, starts, ends)
            line = np.searchsorted(piece.bounds, starts, side="right") - 1
            order = np.lexsort((h, line))
            h, line = h[order], line[order]
            fresh = np.append(True, (h[1:] != h[:-1]) | (line[1:] != line[:-1]))[: len(h)]
            h, line = h[fresh], line[fresh]
            bounds = np.searchsorted(line, np.arange(piece.last - piece.first + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers[piece.first : piece.last], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(h.view(np.int64))),
                ],
                names=["n", "words"],
            )


def _verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, threshold: Fraction) -> DataFrame:
    """Numbers of the later sets of those pairs (a_n, b_n) that are alike."""
    wanted = pairs.select(F.col("a_n").alias("n")).union(pairs.select("b_n")).distinct()
    lines = (
        sets.join(wanted, "n", "left_semi")
        .groupBy(F.nullif("first.doc", F.lit(_NO_ID)).alias("doc_id"), "first.text_hash")
        .agg(F.collect_list(F.struct("n", "first.line")).alias("lines"))
    )
    lines = if_small(keep(lines, "candidate-lines"))
    texts = docs.select("doc_id", "text", text_hash())
    chosen = texts.join(lines, same(texts, lines, ["doc_id", "text_hash"])).select("text", "lines")
    words = chosen.mapInArrow(_line_words, "n bigint, words array<bigint>")
    # Rows equal in id and text give the same lines.
    words = keep(words.dropDuplicates(["n"]), "candidate-words")
    for s in "ab":
        pairs = pairs.join(words.select(F.col("n").alias(f"{s}_n"), F.col("words").alias(f"{s}_words")), f"{s}_n")
    shared = F.size(F.array_intersect("a_words", "b_words"))
    union = F.size("a_words") + F.size("b_words") - shared
    alike = shared * threshold.denominator >= union * threshold.numerator
    return pairs.where(alike).select(F.col("b_n").alias("n")).distinct()


def repeated_lines(docs: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """Lines to remove: doc_id, text_hash, and the lines' numbers as ``removed``.

    One row per different (doc_id, text) that loses a line. Rows that are equal in
    both are one document and share their lines' fate. Lines are split at line
    feeds and numbered from 0; lines without words are neither compared nor
    removed; so a null or empty text has no row. Nothing is cut or sampled.
    """
    lines = keep(line_sets(docs, threshold), "lines")
    place = F.struct(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"), "line", "text_hash")
    sets = lines.groupBy(*_SET).agg(
        F.min(place).alias("first"), F.first(F.struct("skip", "tokens")).alias("prefix"),
        F.first("n_postings").alias("n_postings"), (F.count("*") > 1).alias("copied"),
    )
    sets = keep(sets.withColumn("n", F.monotonically_increasing_id()), "line-sets")
    total = sets.agg(F.sum("n_postings")).first()[0] or 0
    ordered = (
        sets.select("n", *_SET[1:], "first.doc", "first.line", "prefix.skip", "prefix.tokens", "n_postings")
        .mapInArrow(_bundles(max(1, -(-total // PART_POSTINGS))), _BUNDLE)
        .repartition("key")
        .sortWithinPartitions("key")  # of one number: a radix sort; tasks order the lists of a part
    )
    found = ordered.groupBy("key").applyInArrow(_earliest(threshold), "a_doc bigint, a_line int, a_n bigint, b_n bigint")
    earliest = F.min(F.struct("a_doc", "a_line", "a_n")).alias("a")
    pairs = keep(found.groupBy("b_n").agg(earliest).select("a.a_n", "b_n"), "line-pairs")
    later = keep(_verified(docs, sets, pairs, threshold), "later-lines")
    doubtful = pairs.select(F.col("b_n").alias("n")).join(later, "n", "left_anti")
    doubtful = if_small(keep(doubtful, "doubtful-lines"))
    # Each doubtful line against all parts of its lists; a part, above the word in one
    # number, is one key of the join.
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cells") - 1)).alias("part")
    listed = F.shiftleft("part", 32).bitwiseOR(F.col("token")).alias("key")
    probes = _listed(sets.join(doubtful, "n", "left_semi")).select("*", part).select("*", listed)
    probes = if_small(keep(probes, "probes"))
    lists = _listed(sets).withColumn("part", _salt().cast("bigint")).select("*", listed)
    rest = lists.alias("a").join(probes.alias("b"), F.col("a.key") == F.col("b.key"))
    rest = rest.where(_alike(threshold)).select(F.col("a.n").alias("a_n"), F.col("b.n").alias("b_n"))
    more = _verified(docs, sets, keep(rest.distinct(), "more-pairs"), threshold)
    later = keep(later.union(more), "later-lines")

    firsts = sets.select("n", *_SET, "first", "copied").join(later.withColumn("later", F.lit(True)), "n", "left")
    # Of the others the only line stays.
    firsts = firsts.where(F.col("copied") | F.col("later"))
    gone = F.coalesce("later", F.lit(False)) | (place != F.col("first"))
    return (
        lines.drop("skip", "tokens", "n_postings")
        .join(firsts.drop("n", "copied"), _SET)
        .where(gone)
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set("line")).alias("removed"))
    )


def dedup_lines(docs: DataFrame, threshold: Fraction = THRESHOLD, counts: bool = False) -> DataFrame:
    """The documents without repeated lines, with all their columns.

    Only ``text`` changes, and n_chars with it if there is such a column; with
    ``counts``, n_removed_ is added. No document is dropped: one of which every line
    is a repeat keeps an empty text. Documents without repeats keep their text as it
    is, null or empty ones too.
    """
    own = "_"  # begins none of the documents' names
    while any(name.startswith(own) for name in docs.columns):
        own += "_"
    gone = repeated_lines(docs, threshold).select(
        F.col("doc_id").alias(f"{own}id"), F.col("text_hash").alias(f"{own}hash"), F.col("removed").alias(f"{own}gone")
    )
    gone = if_small(keep(gone, "repeated-lines"))
    match = docs["doc_id"].eqNullSafe(gone[f"{own}id"]) & F.xxhash64(docs["text"]).eqNullSafe(gone[f"{own}hash"])
    removed = gone[f"{own}gone"]
    # Only texts that lose lines are sent; each is split once.
    shorter = _without(F.when(removed.isNotNull(), docs["text"]), removed).alias(f"{own}left")
    rows = docs.join(gone, match, "left").select(*[docs[c] for c in docs.columns], removed, shorter)
    changed = F.col(f"{own}gone").isNotNull()
    new = {"text": F.col(f"{own}left.text"), "n_chars": F.col(f"{own}left.n_chars")}
    columns = [
        F.when(changed, new[name]).otherwise(F.col(f"`{name}`")).cast(kind).alias(name)
        if name in new else F.col(f"`{name}`")
        for name, kind in docs.dtypes
    ]
    if counts:
        columns.append(F.when(changed, F.size(f"{own}gone")).otherwise(0).alias("n_removed_"))
    return rows.select(*columns)


_LEFT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def _left_of(text: pa.Array, removed: pa.Array) -> pa.Array:
    """Texts without some of their lines; null where there is no text."""
    left = []
    for whole, numbers in zip(text, removed):
        if not whole.is_valid or not numbers.is_valid:
            left.append(None)
            continue
        gone = set(numbers.as_py())
        left.append("\n".join(line for i, line in enumerate(whole.as_py().split("\n")) if i not in gone))
    texts = pa.array(left, pa.string())
    chars = pa.array([None if x is None else len(x) for x in left], pa.int64())
    return pa.StructArray.from_arrays([texts, chars], names=["text", "n_chars"])


# It is deterministic; Spark is told otherwise so that a filter on the text that is left
# is not pushed below it, which would split each text twice, by two workers a task.
_without = F.arrow_udf(_left_of, _LEFT).asNondeterministic()


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines removed, and the text that is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, counts=True).select(
        "doc_id",
        F.col("n_removed_").cast("bigint").alias("n_removed"),
        "text",
    )
