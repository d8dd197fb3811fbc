"""Words, their hashes and shingles for many texts at once, on the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, U64)
_inverse = np.ones(1, U64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Words are runs of what is not [\x20\x09-\x0D].
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

# Words are runs of digits, letters and everything beyond ASCII, after lower-casing.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < size:
        room = max(size, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        ones = np.full(room, _BASE, U64)
        ones[0] = 1
        _powers = np.cumprod(ones)
        ones = np.full(room, inverse, U64)
        ones[0] = 1
        _inverse = np.cumprod(ones)
    return _powers, _inverse


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column in one array, and where each text starts and the last ends."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """Words of several texts: text ``i`` has words ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word: a polynomial of its bytes, scrambled."""
        powers, inverse = _power_tables(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, U64)
        np.cumsum((self.data.astype(U64) + U64(1)) * powers[: len(self.data)], out=total[1:])
        return mix((total[self.end] - total[self.start]) * inverse[self.start])

    def text(self, word: int) -> bytes:
        return self.data[self.start[word] : self.end[word]].tobytes()


def find_words(column: pa.Array, kind: np.ndarray = SPACED) -> Words:
    """Words of every text of a string column, A to Z lower-cased; null has none."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    inside = kind[data]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    if len(edges):
        last = np.append(edges[1:], len(data)) - 1
        ends[last] = inside[last]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def shingles(words: Words, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``width`` words.

    A text of fewer words has its whole sequence as one; without words there are none.
    """
    hashes = words.hashes()
    weights = [U64(pow(_BASE, 3 * i + 5, 1 << 64)) for i in range(width)]
    runs = np.zeros(max(len(hashes) - width + 1, 0), U64)
    for i, weight in enumerate(weights):
        runs += hashes[i : i + len(runs)] * weight
    runs = mix(runs)
    for low, high in zip(words.first[:-1], words.first[1:]):
        if high - low >= width:
            yield np.unique(runs[low : high - width + 1])
        elif high > low:
            whole = hashes[low:high] * np.array(weights[: high - low], U64)
            yield mix(whole.sum(keepdims=True, dtype=U64) + U64(high - low))
        else:
            yield np.zeros(0, U64)
