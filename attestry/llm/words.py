"""Words of whole texts as numpy arrays.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r.  All six are ASCII, so
words can be cut and hashed on the UTF-8 bytes that Arrow hands over, without decoding
a text or making a Python object per word.  A null text has no words.

Work is done block by block (``BLOCK`` bytes of text, or one text if it is longer), so a
task's memory follows the longest text and not the size of its partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once. Arrays of a block take some 50 times as much, in every worker.
BLOCK = 1 << 18

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_LANES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; kept up to one block's length."""
    have = _powers.get(base)
    if have is not None and len(have[0]) >= n:
        return have
    size = max(n, BLOCK + 1)

    def run(b: int) -> np.ndarray:
        out = np.empty(size, np.uint64)
        out[0] = 1
        done = 1
        while done < size:
            step = min(done, size - done)
            out[done : done + step] = out[:step] * np.uint64(pow(b, done, 1 << 64))
            done += step
        return out

    table = run(base), run(pow(base, -1, 1 << 64))
    if size <= 4 * BLOCK:
        _powers[base] = table
    return table


def _ranges(values: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, by prefix sums."""
    up, down = _power_table(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[end] - sums[start]) * down[start]


def byte_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    return mix(_ranges(_BYTE[data], _BASE, start, end) + (end - start).astype(np.uint64) * np.uint64(_LANES[0]))


@dataclass
class Words:
    """Words of consecutive texts: byte spans, the row of each, and each row's first word."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # row r has bytes offsets[r]:offsets[r + 1]
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray  # row r has words first[r]:first[r + 1]

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; ``lower`` folds A-Z first."""
        data = _LOWER[self.data] if lower else self.data
        return byte_hash(data, self.start, self.end)

    def windows(self, width: int) -> np.ndarray:
        """Indices of the words that begin a window of ``width`` words of one row."""
        last = np.repeat(self.first[1:], self.count) - width
        at = np.arange(len(self.start))
        return at[at <= last]


def sequence_hash(word_hash: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hash of each word sequence [start, end); two lanes together make 128 bits."""
    values = word_hash if lane == 0 else mix(word_hash ^ np.uint64(_LANES[1]))
    h = _ranges(values, _LANES[lane], start, end)
    return mix(h ^ ((end - start).astype(np.uint64) * np.uint64(_BASE)))


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = _IS_WORD[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[:-1][np.diff(offsets) > 0]  # texts touch: a word never runs over an edge
    begins[edge] = inside[edge]
    edge = edge[edge > 0] - 1
    ends[edge] = inside[edge]
    start = np.flatnonzero(begins)
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, start, np.flatnonzero(ends) + 1, row, first)


def blocks(texts: pa.Array | pa.ChunkedArray, limit: int = BLOCK) -> Iterator[tuple[int, int, Words]]:
    """(from row, to row, their words), each of ``limit`` bytes at most or one row."""
    data, offsets = text_bytes(texts)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        part = offsets[at : to + 1]
        yield at, to, split(data[part[0] : part[-1]], part - part[0])
        at = to
