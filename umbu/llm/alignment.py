"""Alignment of two tokenizers' tokens over the bytes of the same texts.

Both cut the bytes of a space and the text into tokens. In each Arrow batch the tokens
of both sides lie in one order of bytes, so that two as-of merges, keyed by document,
find for each token of one side the token of the other that covers its first byte.
Of two tokens that overlap, the one that begins later begins inside the other: the
union of both directions is exactly the overlapping pairs (links). Offsets where
tokens of both sides end cut the text into groups.

How many documents hold a pair of ids linked is a grouped count over each document's
distinct pairs; a document's sums over its links come from a join with these counts.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.llm.tables import if_small, keep, table
from umbu.llm.words import pieces

# Where the vocabularies of public tokenizers are, on every machine.
FOLDER = "/opt/tokenizers"
BYTES_FILE = "byte_bpe_50k.json"
PIECES_FILE = "piece_bpe_32k.model"
# Pairs of ids with their counts are broadcast up to so many, counted beforehand
# (17 bytes each); beyond them the join is a shuffle.
DICTIONARY_ROWS = 2_000_000

# How this kind of vocabulary cuts texts before merging, and the
# bytes that stand for themselves in its entries.
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]

# Runs of white space from here on go to the slower library: the faster one's
# expressions run out of stack on very long ones.
_LONG_SPACE = re.compile(r"\s{1000}")
# Neither side joins what lies on the two sides of such a space.
_WORD_SPACE = re.compile(r"(?<=\S) (?=\S)")
# A worker keeps the ids of about so many words in mind.
KEPT_WORDS = 200_000

_GROUPS = "row bigint, doc_id bigint, a array<int>, b array<int>, a_sizes array<int>, b_sizes array<int>"
_SUMS = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
    " groups_sha256 string, pairs array<bigint>, times array<int>"
)


class ByteTokenizer:
    """Byte-level merges; ids of whole texts, and the bytes of each id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocabulary, cut = model["model"]["vocab"], model["pre_tokenizer"]
        special = {token["content"] for token in model["added_tokens"]}
        others = iter(range(256, 512))
        byte = {chr(b if b in _PLAIN else next(others)): b for b in range(256)}
        ids = {bytes(byte[c] for c in k): i for k, i in vocabulary.items() if k not in special}
        self.bytes_of: list[bytes] = [b""] * (1 + max(vocabulary.values()))
        for entry, i in ids.items():
            self.bytes_of[i] = entry
        self._slow = Tokenizer.from_file(path)
        self._slow.encode_special_tokens = True
        #: No token holds the end of a word and the space after it.
        self.by_words = cut["type"] == "ByteLevel" and cut["use_regex"]
        merges = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in model["model"]["merges"]]
        self._fast = None
        if self.by_words and [vocabulary[m] for m in merges] == list(range(256, 256 + len(merges))):
            import tiktoken  # ids in the order of the merges are ranks

            self._fast = tiktoken.Encoding("ranked", pat_str=_CUTS, mergeable_ranks=ids, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self._fast is None or _LONG_SPACE.search(text):
            return self._slow.encode(text, add_special_tokens=False).ids
        return self._fast.encode_ordinary(text)


class PieceTokenizer:
    """Pieces with byte fallback; adds the space in front itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=path)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.bytes_of = [
            bytes([int(name[3:5], 16)]) if self._model.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self.by_words = not any(re.search("[^▁]▁", name) for name in names)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1) if texts else []


class Tokens:
    """Ids on both sides of texts, with those of frequent words kept in mind.

    Neither side has a token across the space between two words, so a text's ids
    are those of its words in a row. Where that does not hold, or where a word's
    bytes are changed, the text is taken whole.
    """

    def __init__(self, folder: str):
        self.one = ByteTokenizer(f"{folder}/{BYTES_FILE}")
        self.two = PieceTokenizer(f"{folder}/{PIECES_FILE}")
        self.by_words = self.one.by_words and self.two.by_words
        self.lengths = [np.array([len(x) for x in t.bytes_of]) for t in (self.one, self.two)]
        self._forget()

    def _forget(self) -> None:
        self._place: dict[str, int] = {}
        self._ids = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self._counts = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self._same = np.zeros(0, bool)

    def _encoded(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Ids and their number per word on both sides, and whether the bytes are the word's."""
        whole = "".join(f" {word}" for word in words)
        size = np.array([len(word.encode()) + 1 for word in words], dtype=np.int64)
        a = np.array(self.one.encode(whole), dtype=np.int64)
        a_until = np.searchsorted(np.cumsum(self.lengths[0][a]), np.cumsum(size)) + 1
        lists = self.two.encode_all(words)
        b_count = np.fromiter(map(len, lists), np.int64, len(lists))
        b = np.fromiter(chain.from_iterable(lists), np.int64, int(b_count.sum()))
        b_bytes = np.concatenate([[0], np.cumsum(self.lengths[1][b])])
        b_until, raw = np.cumsum(b_count), whole.encode()
        got = b"".join(map(self.two.bytes_of.__getitem__, b.tolist()))
        same = b_bytes[b_until] - b_bytes[b_until - b_count] == size
        if got != raw:
            ends = np.cumsum(size)
            for k in np.flatnonzero(same):
                at = b_bytes[b_until[k]]
                same[k] = got[at - size[k] : at] == raw[ends[k] - size[k] : ends[k]]
        return [a, b], [np.diff(a_until, prepend=0), b_count], same

    def _learn(self, words: set[str]) -> None:
        new = list(words - self._place.keys())
        # Words with white space at an end, or texts taken whole, stand alone.
        alone = [w for w in new if not self.by_words or w[0].isspace() or w[-1].isspace()]
        if alone:
            gone = set(alone)
            new = [w for w in new if w not in gone]
        for some in ([new] if new else []) + [[w] for w in alone]:
            ids, counts, same = self._encoded(some)
            self._place.update(zip(some, range(len(self._same), len(self._same) + len(some))))
            self._ids = [np.concatenate(x) for x in zip(self._ids, ids)]
            self._counts = [np.concatenate(x) for x in zip(self._counts, counts)]
            self._same = np.concatenate([self._same, same])

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides, and the number of the text of each id."""
        if len(self._same) > KEPT_WORDS or sum(map(len, self._ids)) > 20 * KEPT_WORDS:
            self._forget()
        words = [[] if not text else text.split(" ") if self.by_words else [text] for text in texts]
        seen = set(chain.from_iterable(words))
        odd = {w for w in seen if not w or w[0].isspace() or w[-1].isspace()}
        if self.by_words and odd:
            words = [w if odd.isdisjoint(w) else _WORD_SPACE.split(t) for t, w in zip(texts, words)]
            seen = set(chain.from_iterable(words))
        flat = list(chain.from_iterable(words))
        self._learn(seen)
        word = np.fromiter(map(self._place.__getitem__, flat), np.int64, len(flat))
        doc = np.repeat(np.arange(len(texts)), [len(each) for each in words])
        if not self._same[word].all():
            # Words with other bytes: their texts are taken whole, and left out if that fails.
            changed = np.unique(doc[~self._same[word]])
            self._learn({texts[k] for k in changed})
            whole = np.array([self._place[texts[k]] for k in changed])
            kept = ~np.isin(doc, changed)
            doc = np.concatenate([doc[kept], changed[self._same[whole]]])
            word = np.concatenate([word[kept], whole[self._same[whole]]])
            order = np.argsort(doc, kind="stable")
            doc, word = doc[order], word[order]
        out = []
        for ids, counts in zip(self._ids, self._counts):
            count = counts[word]
            first = (np.cumsum(counts) - counts)[word] - (np.cumsum(count) - count)
            out += [ids[np.repeat(first, count) + np.arange(count.sum())], np.repeat(doc, count)]
        return out[0], out[2], out[1], out[3]


_tokens = functools.cache(Tokens)  # loaded once in each Python worker


@dataclass
class Aligned:
    """Tokens of some texts on both sides, their documents, groups and links."""

    a: np.ndarray
    b: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    a_group: np.ndarray  # over all texts, ascending
    b_group: np.ndarray
    group_doc: np.ndarray
    link_a: np.ndarray  # places in a and b
    link_b: np.ndarray


def aligned(texts: list[str | None], folder: str = FOLDER) -> Aligned:
    """Align some texts.

    Null and empty texts have no tokens, and neither have texts whose bytes either
    side changes (a normalised character, say).
    """
    tokens = _tokens(folder)
    a, b, a_doc, b_doc = tokens.of(texts)
    a_length, b_length = tokens.lengths
    # Bytes count on through the texts, which are as long on either side.
    a_end, b_end = np.cumsum(a_length[a]), np.cumsum(b_length[b])
    a_at, b_at = a_end - a_length[a], b_end - b_length[b]
    left = pd.DataFrame({"at": a_at, "doc": a_doc, "a": np.arange(len(a))})
    right = pd.DataFrame({"at": b_at, "doc": b_doc, "b": np.arange(len(b))})
    cover_b = pd.merge_asof(left, right, on="at", by="doc")["b"].to_numpy(dtype=np.int64)
    cover_a = pd.merge_asof(right, left, on="at", by="doc")["a"].to_numpy(dtype=np.int64)
    later = a_at[cover_a] != b_at  # equal beginnings are links of the first direction
    link_a = np.concatenate([np.arange(len(a)), cover_a[later]])
    link_b = np.concatenate([cover_b, np.flatnonzero(later)])
    size = int(a_end[-1]) if len(a_end) else 0
    ends = np.zeros((2, size + 1), dtype=bool)
    ends[0, a_end], ends[1, b_end] = True, True
    cuts = ends[0] & ends[1]
    before = np.cumsum(cuts)
    group_end = np.flatnonzero(cuts)
    a_group, b_group = before[a_end - 1], before[b_end - 1]
    group_doc = a_doc[np.searchsorted(a_end, group_end)]
    return Aligned(a, b, a_doc, b_doc, a_group, b_group, group_doc, link_a, link_b)


def _digests(x: Aligned, docs: int) -> list[str]:
    """The lowercase hex SHA-256 of each document's groups as text; '' without tokens."""
    groups = len(x.group_doc)
    a_count, b_count = (np.bincount(g, minlength=groups) for g in (x.a_group, x.b_group))
    a_until, b_until = np.cumsum(a_count), np.cumsum(b_count)
    # Places of all tokens: group by group, a's before b's.
    a_place = np.arange(len(x.a)) + (b_until - b_count)[x.a_group]
    b_place = np.arange(len(x.b)) + a_until[x.b_group]
    total = len(x.a) + len(x.b)
    ids, mark = np.zeros(total, dtype=np.int64), np.full(total, ord(","), dtype=np.uint8)
    ids[a_place], ids[b_place] = x.a, x.b
    mark[a_place[a_until - 1]] = ord("|")
    mark[b_place[b_until - 1]] = ord(";")
    width = len(str(int(ids.max()))) if total else 1
    some = np.arange(int(ids.max()) + 1 if total else 1)
    digits = 1 + sum(some >= 10**k for k in range(1, width))
    cells = np.full((len(some), width + 1), 48, dtype=np.uint8)
    for k in range(width):
        cells[:, k] += (some // 10 ** (width - 1 - k) % 10).astype(np.uint8)
    used = np.arange(width + 1) >= (width - digits)[:, None]
    text = cells[ids]
    text[:, width] = mark
    data, until = text[used[ids]], np.cumsum(digits[ids] + 1)
    held = np.bincount(x.a_doc, minlength=docs) + np.bincount(x.b_doc, minlength=docs)
    bounds = np.concatenate([[0], until[np.cumsum(held)[held > 0] - 1]]) if total else np.zeros(1, int)
    out, raw, k = [""] * docs, data.tobytes(), 0
    for doc in np.flatnonzero(held):
        out[doc] = hashlib.sha256(raw[bounds[k] : bounds[k + 1] - 1]).hexdigest()
        k += 1
    return out


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _of_pieces(batches: Iterator[pa.RecordBatch], folder: str):
    """(row, doc_id, number of documents, aligned texts) of bounded pieces."""
    for batch in batches:
        for piece in pieces(batch.column(2)):
            n = piece.last - piece.first
            row, doc_id, text = (c.slice(piece.first, n) for c in batch.columns)
            yield row, doc_id, n, aligned(text.to_pylist(), folder)


def _group_rows(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for row, doc_id, n, x in _of_pieces(batches, folder):
        per = np.bincount(x.group_doc, minlength=n)
        sizes = [np.bincount(g, minlength=len(x.group_doc)) for g in (x.a_group, x.b_group)]
        yield pa.RecordBatch.from_arrays(
            [
                row, doc_id,
                _lists(x.a, np.bincount(x.a_doc, minlength=n), pa.int32()),
                _lists(x.b, np.bincount(x.b_doc, minlength=n), pa.int32()),
                *[_lists(s, per, pa.int32()) for s in sizes],
            ],
            names=["row", "doc_id", "a", "b", "a_sizes", "b_sizes"],
        )


def _sum_rows(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for row, doc_id, n, x in _of_pieces(batches, folder):
        span = len(_tokens(folder).two.bytes_of)
        pair, doc = x.a[x.link_a] * span + x.b[x.link_b], x.a_doc[x.link_a]
        # One number holds document and pair: fewer than 2**20 documents a piece.
        key, times = np.unique((doc << 43) | pair, return_counts=True)
        count = lambda docs: pa.array(np.bincount(docs, minlength=n), pa.int64())
        distinct = np.bincount(key >> 43, minlength=n)
        yield pa.RecordBatch.from_arrays(
            [
                row, doc_id, count(x.a_doc), count(x.b_doc), count(x.group_doc), count(doc),
                pa.array(_digests(x, n)),
                _lists(key & ((1 << 43) - 1), distinct, pa.int64()),
                _lists(times, distinct, pa.int32()),
            ],
            names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
        )


def _rows(docs: DataFrame) -> DataFrame:
    row = F.monotonically_increasing_id().alias("row")
    return docs.select(row, F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def token_groups(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """The aligned tokens of every document, unwritten.

    row, doc_id, ids ``a`` and ``b`` in order, and how many of each lie in each
    group. Null, empty and changed texts have empty lists. Repeated rows are rows of
    their own; other columns are not looked at; an empty table gives no rows.
    """
    return _rows(docs).mapInArrow(functools.partial(_group_rows, folder=folder), _GROUPS)


def pair_counts(aligned_docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """pair, documents that hold it linked, and whether it is its first id's best."""
    span = F.lit(len(PieceTokenizer(f"{folder}/{PIECES_FILE}").bytes_of))
    counts = aligned_docs.select(F.explode("pairs").alias("pair")).groupBy("pair")
    counts = keep(counts.agg(F.count(F.lit(1)).alias("n_docs")), "pair-counts")
    first = F.expr("pair div span").alias("a")
    counts = counts.withColumn("span", span.cast("bigint")).select("pair", "n_docs", first)
    best = keep(counts.groupBy("a").agg(F.max("n_docs").alias("most")), "best-pairs")
    found = counts.join(if_small(best), "a").select("pair", "n_docs", F.expr("n_docs = most").alias("best"))
    return keep(found, "pairs")


def link_sums(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """One row per document: tokens, groups, links, and sums over its links.

    ``n_best`` counts links whose pair is in as many documents as any pair of its
    ``a`` id (ties count), ``count_sum`` adds the documents of each link's pair. Null
    ids and repeated rows are kept as they are. Texts without tokens have zeros and an
    empty ``groups_sha256``; an empty table gives no rows.
    """
    kept = keep(_rows(docs).mapInArrow(functools.partial(_sum_rows, folder=folder), _SUMS), "aligned")
    pairs = if_small(pair_counts(kept, folder), DICTIONARY_ROWS)
    links = kept.select("row", F.inline(F.arrays_zip("pairs", "times")))
    links = links.withColumnRenamed("pairs", "pair")
    sums = links.join(pairs, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times").cast("bigint")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return kept.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of the alignment of every document; see ``link_sums`` for all cases."""
    return link_sums(table(spark, sf_dir, "documents").select("doc_id", "text"))
