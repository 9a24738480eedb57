"""Vectorised word and n-gram hashing over Arrow string columns.

Everything here works on whole columns with numpy; no Python loop runs per
word.  Hashes are functions of the bytes alone, equal on every machine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64


def _stream(seed: int, n: int) -> np.ndarray:
    """n odd-looking 64-bit constants from a counter, by the splitmix64 mixer."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit values that spreads all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


_BYTE = _stream(11, 256)
_BASE = U(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def strings(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


class Words:
    """The words of a column of texts: ``hash`` by word, ``first`` by text.

    Words of text i are those numbered first[i] to first[i + 1] - 1.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        if lower:
            data = _LOWER[data]
        n = len(data)
        solid = ~_SPACE[data]
        start = solid.copy()
        start[1:] &= ~solid[:-1]
        edge = offsets[:-1][offsets[:-1] < n]
        start[edge] = solid[edge]
        starts = np.flatnonzero(start)
        self.first = np.searchsorted(starts, offsets).astype(np.int64)
        if not len(starts):
            self.hash = np.zeros(0, U)
            return
        word = np.cumsum(start, dtype=np.int32)
        word -= 1
        place = np.arange(n, dtype=np.int64)
        place -= starts[np.maximum(word, 0)]
        np.maximum(place, 0, out=place)
        longest = int(place[solid].max()) + 1
        with np.errstate(over="ignore"):
            power = np.cumprod(np.concatenate([[U(1)], np.full(longest - 1, _BASE, U)]))
            place[~solid] = 0
            value = _BYTE[data]
            value *= power[place]
            value[~solid] = 0
            total = np.add.reduceat(value, starts)
            length = np.add.reduceat(solid.astype(np.int64), starts).astype(U)
            self.hash = mix(total ^ (length * U(0xD6E8FEB86659FD93)))

    def grams(self, k: int, seed: int) -> np.ndarray:
        """By word, the hash of the k words that start there, across text ends too; see ``whole``."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, U)
        c = _stream(seed, k) | U(1)
        with np.errstate(over="ignore"):
            out = self.hash[:n] * c[0]
            for i in range(1, k):
                out += self.hash[i : n + i] * c[i]
        return mix(out)

    def whole(self, k: int) -> np.ndarray:
        """Which k-grams lie in one text."""
        n = max(0, len(self.hash) - k + 1)
        return np.arange(n) + k <= np.repeat(self.first[1:], np.diff(self.first))[:n]

    def text_of(self) -> np.ndarray:
        """By word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def slices(column, most_bytes: int):
    """Row ranges of a string column of about ``most_bytes`` each, one row at least."""
    _, off = strings(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most_bytes, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
