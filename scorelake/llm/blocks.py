"""Texts of an Arrow batch as flat byte arrays: words, hashes and shingles without a Python loop per word.

A word is ``[^\\x20\\x09-\\x0D]+``; A-Z count as a-z. A block holds whole texts of a few megabytes together, a longer
text is a block of its own. Beside the bytes, working memory is about ten bytes a byte of the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.session import ship_by_value

ship_by_value(__name__)

BLOCK_BYTES = 1 << 20
BIT_COUNT = 1 << 25

SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_random = np.random.default_rng(5)
_BYTE_CODES = (_random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[FOLD]
_STEP = int(_random.integers(1 << 40, 1 << 62)) * 2 + 1
_PLACES = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX_A = np.uint64(0xFF51AFD7ED558CCD)
_MIX_B = np.uint64(0xC4CEB9FE1A85EC53)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(33))
    h *= _MIX_A
    h ^= h >> np.uint64(33)
    h *= _MIX_B
    h ^= h >> np.uint64(33)
    return h


def text_blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive whole texts; null is an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs where ``inside`` holds, cut at text borders, and the first run of each text."""
    size = len(inside)
    if not size:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    border = np.zeros(size + 1, dtype=bool)
    border[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | border[1:size]
    ends[:-1] &= ~inside[1:] | border[1:size]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class Hasher:
    """Hashes of spans of bytes; made once in a task, for its tables."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def _reach(self, size: int) -> None:
        """Powers of the step and of its inverse modulo 2**64, up to ``size``."""
        if len(self.up) < size:
            both = []
            for base in (_STEP, pow(_STEP, -1, 1 << 64)):
                row = np.full(1 << max(size - 1, BLOCK_BYTES).bit_length(), base, dtype=np.uint64)
                row[0] = 1
                both.append(np.cumprod(row))
            self.up, self.down = both

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each span's lower-cased bytes: a polynomial from running sums, then mixed."""
        out = np.empty(len(starts), dtype=np.uint64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + BLOCK_BYTES)))
            low, high = int(starts[i]), int(ends[j - 1])
            self._reach(high - low)
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum(_BYTE_CODES[data[low:high]] * self.up[: high - low], out=sums[1:])
            out[i:j] = (sums[ends[i:j] - low] - sums[starts[i:j] - low]) * self.down[starts[i:j] - low]
            i = j
        return mix(out)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word in order, and where each text's words begin (one more entry than texts)."""
        starts, ends, first = spans(~SPACES[data], offsets)
        return self.spans(data, starts, ends), first


def shingles(tokens: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` tokens of one text, its token position, and where each text's runs begin.

    A text with fewer tokens, but some, has its whole sequence as one.
    """
    counts = np.diff(first)
    padded = np.concatenate([tokens, np.zeros(size, dtype=np.uint64)])
    hashes = np.zeros(len(tokens), dtype=np.uint64)
    for k in range(size):
        hashes += padded[k : k + len(tokens)] * _PLACES[k]
    short = np.flatnonzero((counts > 0) & (counts < size))
    for d in short:
        own = tokens[first[d] : first[d + 1]]
        hashes[first[d]] = np.sum(np.append(own * _PLACES[: len(own)], _PLACES[63 - len(own)]), dtype=np.uint64)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(runs)])
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], runs)
    return mix(hashes[at]), at, begin


def bitmap(df: DataFrame, key: Column) -> np.ndarray:
    """Fixed-size bit set of 64-bit keys, as 64-bit words: 4 MB whatever ``df`` holds.

    A filter before an exact join: it lets every key of ``df`` through, and few others while it is sparse.
    """
    bit = df.select(key.bitwiseAND(F.lit(BIT_COUNT - 1)).alias("b"))
    rows = (
        bit.groupBy(F.shiftright("b", 6).alias("w"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 AS int)))").alias("v"))
        .toPandas()
    )
    out = np.zeros(BIT_COUNT >> 6, dtype=np.uint64)
    out[rows["w"].to_numpy(dtype=np.int64)] = rows["v"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(BIT_COUNT - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
