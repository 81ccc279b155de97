"""Word and window hashing of many texts at once, for use inside Arrow tasks.

A *word* is a run of characters other than space and \\x09-\\x0D.  Texts are
handled as their UTF-8 bytes, whole, in blocks of whole documents; nothing
is cut.  Hashes are 64 bits: a polynomial over the bytes of a word, mixed, and
a second polynomial over mixed word hashes for windows of several words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_powers: dict[int, np.ndarray] = {}

#: Bytes of text that one block holds (one longer document is a block of its own).
BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds)."""
    x = (x + U64((seed * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) & (2**64 - 1))).astype(np.uint64, copy=False)
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64; kept per base, with some room to grow."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        steps = np.full(n + n // 8 + (1 << 12), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have


def range_hash(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of codes[start:end] for each pair, from one prefix sum."""
    n = len(codes)
    prefix = np.empty(n + 1, dtype=np.uint64)
    prefix[0] = 0
    np.cumsum(codes * powers(_BASE, n)[:n], out=prefix[1:])
    return (prefix[end] - prefix[start]) * powers(_BASE_INV, n)[start]


def window_hash(codes: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k codes from each position in ``first``; the length is part of it."""
    return mix(range_hash(codes, first, first + k), k)


@dataclass
class Words:
    """Words of a block of documents: byte ranges, hashes, and each document's range of words."""

    data: np.ndarray        # bytes of all texts, one after the other
    offsets: np.ndarray     # document i is data[offsets[i]:offsets[i+1]]
    start: np.ndarray       # first byte of each word
    end: np.ndarray         # byte after each word
    code: np.ndarray        # mixed 64-bit hash of each word
    ptr: np.ndarray         # words of document i are ptr[i]:ptr[i+1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), self.counts)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, document) of every window of k words that lies in one document."""
        n = np.maximum(self.counts - (k - 1), 0)
        return ragged(self.ptr[:-1], n), np.repeat(np.arange(len(n)), n)


def ragged(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, .. (n[0] of them), first[1], ..."""
    total = int(n.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(n) - n
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(first, dtype=np.int64) - before, n)


def find_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    if lower:
        data = LOWER[data]
    n = len(data)
    inside = ~IS_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)      # a document begins or ends before this byte
    edge[offsets] = True
    left = np.zeros(n, dtype=bool)          # the byte before belongs to the same word
    if n:
        left[1:] = inside[:-1] & inside[1:] & ~edge[1:n]
    start = np.flatnonzero(inside & ~left)
    right = np.zeros(n, dtype=bool)
    if n:
        right[:-1] = left[1:]
    end = np.flatnonzero(inside & ~right) + 1
    code = mix(range_hash(_BYTE_CODE[data], start, end)) if n else np.zeros(0, dtype=np.uint64)
    return Words(data, offsets, start, end, code, np.searchsorted(start, offsets).astype(np.int64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls as empty texts."""
    column = pc.fill_null(column, "")
    wide = isinstance(column, pa.LargeStringArray)
    _, where, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(where, dtype=kind, count=len(column) + 1 + column.offset)[column.offset:].astype(np.int64)
    if data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(batches, text: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Whole rows of each batch in slices of about ``limit`` text bytes: (rows, bytes, offsets)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        data, offsets = utf8(column)
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
            at = to


def sums(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sum of values[ptr[i]:ptr[i+1]] for each i, empty ranges included."""
    prefix = np.zeros(len(values) + 1, dtype=values.dtype if values.dtype.kind in "uf" else np.int64)
    np.cumsum(values, out=prefix[1:])
    return prefix[ptr[1:]] - prefix[ptr[:-1]]


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """A list column: counts[i] of the values for row i."""
    where = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=where[1:])
    return pa.ListArray.from_arrays(pa.array(where), pa.array(values))
