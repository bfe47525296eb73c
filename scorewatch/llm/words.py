"""Words of many texts at once, as byte positions and hashes in numpy arrays.

Texts come as Arrow string columns and are cut into slices of about SLICE bytes, never
inside a text, so that a task's memory follows the slice and the longest text. A worker
that is used again keeps part of what its largest slice took; no result depends on the cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 400_000

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

U64 = np.uint64
STEP = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the whole 64-bit word."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, seed: int):
        draw = np.random.default_rng(seed)
        self.letter = draw.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
        self.base = int(draw.integers(1, 2**62)) * 4 + 1
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = pow(self.base, -1, 2**64)
            self.up, self.down = (
                np.cumprod(np.concatenate([[U64(1)], np.full(n, b, np.uint64)])) for b in (self.base, inverse)
            )
        return self.up, self.down


_POWERS = [_Powers(1), _Powers(2)]


@dataclass
class Words:
    """Words of a slice: byte ranges in `data`, the first word of each text, hashes."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __post_init__(self) -> None:
        self._sums: dict[int, np.ndarray] = {}

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count)

    def hashes(self, lane: int = 0) -> np.ndarray:
        """A 64-bit hash of every word; two lanes are independent of each other."""
        p = _POWERS[lane]
        up, down = p.to(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(p.letter[self.data] * up[: len(self.data)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))


def windows(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where `size` words of one text begin, and the hash of those words."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total *= STEP
        total += h[j : j + n]
    inside = np.ones(len(h), bool)
    for j in range(1, size):
        last = first[1:] - j
        inside[last[last >= first[:-1]]] = False
    at = np.flatnonzero(inside[:n])
    return at, mix(total[at])


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words `[^\\x20\\x09-\\x0D]+` of texts that lie end to end in `data`."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(data, offsets, none, none, np.zeros(len(offsets), np.int64))
    word = ~SPACE[data]
    begins = np.zeros(n + 1, bool)
    begins[offsets[:-1]] = True
    edge = begins[:n].copy()
    starts = word & (edge | ~np.concatenate([[False], word[:-1]]))
    ends = word & np.concatenate([begins[1:n] | ~word[1:], [True]])
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def slices(texts: pa.Array | pa.ChunkedArray, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, bytes, offsets) of runs of whole texts; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if n == 0:
        return
    _, place, raw = texts.buffers()
    offsets = np.frombuffer(place, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_slices(texts: pa.Array | pa.ChunkedArray, lower: bool = False, size: int = SLICE) -> Iterator[tuple[int, int, Words]]:
    for i, j, data, offsets in slices(texts, size):
        yield i, j, split_words(LOWER[data] if lower else data, offsets)
