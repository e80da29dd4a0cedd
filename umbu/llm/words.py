"""Words of many texts at once: places and 64-bit hashes, with numpy on Arrow buffers.

A word is a run of bytes of one class. Its hash is a polynomial in an odd
number, modulo 2**64, so that all words of a piece are hashed by one running sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are handled in pieces of about this size; one longer text is a piece.
PIECE_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

LETTERS = np.zeros(256, dtype=bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the odd number and of its inverse, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS.clear()
        for base in (_ODD, pow(_ODD, -1, 1 << 64)):
            steps = np.full(max(n, PIECE_BYTES + 1), base, dtype=np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=np.uint64))
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all its bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Piece:
    """Some texts in a row: their bytes, where each begins, and their row numbers."""

    data: np.ndarray
    bounds: np.ndarray
    first: int
    last: int


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[Piece]:
    """Cut a text column into pieces of whole texts; a null is an empty text."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    rows = len(column)
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset : column.offset + rows + 1
    ]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield Piece(
            data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], first, last
        )
        first = last


def mapped(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``values[data]`` of bytes, for values of a byte."""
    return np.frombuffer(data.tobytes().translate(values.tobytes()), dtype=values.dtype)


def word_places(piece: Piece, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a class begin and end; no word spans two texts."""
    n = len(piece.data)
    inside = np.zeros(n + 1, dtype=bool)
    inside[:n] = mapped(piece.data, kind)
    before = np.zeros(n + 1, dtype=bool)
    before[1:] = inside[:n]
    cut = np.zeros(n + 1, dtype=bool)
    cut[piece.bounds] = True
    starts = np.flatnonzero(inside & (~before | cut))
    ends = np.flatnonzero(before & (~inside | cut))
    return starts, ends


def running_sums(data: np.ndarray) -> np.ndarray:
    """Sums of bytes times powers, from which any slice's hash follows."""
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0], terms = 0, sums[1:]
    np.add(data, np.uint64(1), out=terms, dtype=np.uint64)
    terms *= _powers(len(data) + 1)[0][: len(data)]
    np.cumsum(terms, out=terms)
    return sums


def slice_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of slices of the bytes, alike for equal slices; to be mixed."""
    raw = (sums[ends] - sums[starts]) * _powers(len(sums))[1][starts]
    return raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def word_hashes(piece: Piece, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words, A-Z taken as a-z."""
    return mix(slice_hashes(running_sums(mapped(piece.data, LOWER)), starts, ends))


def hashed(texts: list[str | None], kind: np.ndarray) -> list[np.ndarray]:
    """Word hashes of each text, for small lists on the driver."""
    out: list[np.ndarray] = []
    for piece in pieces(pa.array(texts, pa.string())):
        starts, ends = word_places(piece, kind)
        all_words = word_hashes(piece, starts, ends)
        cuts = np.searchsorted(starts, piece.bounds)
        out += [all_words[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    return out
