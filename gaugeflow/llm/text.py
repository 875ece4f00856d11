"""Byte-level text kernels on Arrow columns: words, word hashes and word n-grams.

Every function works on a whole block of documents at once, so Python runs per
block and numpy per byte. Blocks hold a few megabytes of whole documents; only a
single document that is longer makes a longer block. Words are maximal runs of
ASCII letters and digits and of non-ASCII characters, with A-Z lower-cased.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once.
BLOCK_BYTES = 4 << 20
#: Spans of more bytes are hashed by BLAKE2: from some 1,000 bytes on there are different texts
#: that every polynomial modulo 2^64 takes for equal.
LONG_SPAN = 256
#: Bytes hashed at once, so that the running sums stay in the cache.
SLICE_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def word_table() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[48:58] = table[65:91] = table[97:123] = table[128:] = True
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers, from a rule."""
    start = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 0x10000)) * np.uint64(_BASE)
    return mix(start) | np.uint64(1)


class Block(NamedTuple):
    """Some consecutive rows of a batch with their text bytes."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.last - self.first


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and each row's offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    buffers = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a column into blocks of whole rows with about `limit` bytes each."""
    data, offsets = utf8(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        begin = offsets[first]
        yield Block(first, last, data[begin:offsets[last]], offsets[first:last + 1] - begin)
        first = last


class Words(NamedTuple):
    """Words of a block: byte spans, hashes, and each row's range of words."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray

    def row_ends(self) -> np.ndarray:
        """For each word, the number of the first word of the next row."""
        return np.repeat(self.offsets[1:], np.diff(self.offsets))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = word_table()[data]
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] |= inside[edges]
    finishes[edges - 1] |= inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(finishes) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span (sorted, not overlapping), independent of its place."""
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    at, n = 0, len(starts)
    base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    powers = inverses = np.ones(1, np.uint64)
    while at < n:
        begin = int(starts[at])
        to = max(int(np.searchsorted(ends, begin + SLICE_BYTES, side="right")), at + 1)
        size = int(ends[to - 1]) - begin
        if len(powers) < size + 1:
            steps = np.full(max(size, SLICE_BYTES) + 1, base)
            steps[0] = 1
            powers = np.cumprod(steps)
            steps[1:] = inverse
            inverses = np.cumprod(steps)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((data[begin:begin + size].astype(np.uint64) + np.uint64(1)) * powers[:size],
                  out=sums[1:])
        s, e = starts[at:to] - begin, ends[at:to] - begin
        out[at:to] = (sums[e] - sums[s]) * inverses[s]
        at = to
    out = mix(out ^ (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_SPAN).tolist():
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, np.uint64)[0]
    return out


def words(block: Block) -> Words:
    data = lower_table()[block.data]
    starts, ends = word_spans(data, block.offsets)
    return Words(starts, ends, span_hashes(data, starts, ends),
                 np.searchsorted(starts, block.offsets).astype(np.int64))


def ngrams(hashes: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """A hash of the n words from each place on; the last n - 1 places have none."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, n, np.uint64)
    for j, factor in enumerate(constants(n, seed)):
        total += hashes[j:j + count] * factor
    return mix(total)


def row_ngrams(found: Words, n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that lie within one row, and their first words' numbers."""
    hashes = ngrams(found.hashes, n, seed)
    places = np.flatnonzero(np.arange(len(hashes)) + n <= found.row_ends()[:len(hashes)])
    return hashes[places], places
