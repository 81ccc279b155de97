"""Repetition rules: how much of a text lies inside duplicated n-grams and lines.

Rolling hashes of the windows of several lengths, many documents at a time.  A longer
window can only be duplicated where the shortest one is, so the longer lengths look at
those places only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import _BYTE_CODE, IS_SPACE, blocks, find_words, mix, range_hash, sums, window_hash

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, dup_line_share double, dup5_share double, dup8_share double, dup10_share double, symbol_share double"
)


@dataclass(frozen=True)
class Limits:
    """Shares above which a text is rejected; of its word characters unless said otherwise."""

    dup_lines: float = 0.30         # in lines equal to an earlier line
    dup5: float = 0.35              # in 5-word windows found twice or more
    dup8: float = 0.30
    dup10: float = 0.25
    symbols: float = 0.06           # characters of [#*$%&|<>]


def _duplicated(code: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which values are found twice or more in their document."""
    key = mix(code + mix(doc.astype(np.uint64)))
    order = np.argsort(key)
    key = key[order]
    same = np.zeros(len(key) + 1, dtype=bool)
    same[1:-1] = key[1:] == key[:-1]
    out = np.empty(len(key), dtype=bool)
    out[order] = same[1:] | same[:-1]
    return out


def _covered(first: np.ndarray, k: int, words: int) -> np.ndarray:
    """Words inside the windows of k words that start at ``first`` (ascending)."""
    depth = np.zeros(words + 1, dtype=np.int64)
    depth[first] += 1
    depth[first + k] -= 1
    return np.cumsum(depth)[:-1] > 0


def _dup_lines(data: np.ndarray, offsets: np.ndarray, chars: np.ndarray):
    """Per document: lines with a word that equal an earlier line, and their word characters."""
    docs = len(offsets) - 1
    cut = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([offsets[:-1], cut + 1]))
    start = start[start < len(data)]
    if not len(start):
        return np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    end = np.append(start[1:], len(data))
    end = end - (data[end - 1] == 10)
    has = np.concatenate([[0], np.cumsum(~IS_SPACE[data])])
    some = has[end] > has[start]
    start, end = start[some], end[some]
    doc = np.searchsorted(offsets, start, side="right") - 1
    key = mix(range_hash(_BYTE_CODE[data], start, end) + mix((end - start).astype(np.uint64)) + mix(doc.astype(np.uint64), 5))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), dtype=bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return np.bincount(doc[again], minlength=docs), np.bincount(doc[again], weights=chars[end[again]] - chars[start[again]], minlength=docs).astype(np.int64)


def measure(data: np.ndarray, offsets: np.ndarray, limits: Limits) -> dict[str, np.ndarray]:
    words = find_words(data, offsets)
    n = words.counts
    letters = np.concatenate([[0], np.cumsum(~IS_SPACE[data] & (data & 0xC0 != 0x80))])    # code points in words
    word_chars = letters[offsets[1:]] - letters[offsets[:-1]]
    of_word = letters[words.end] - letters[words.start]
    symbols = sums(SYMBOLS[data].astype(np.int64), offsets)
    dup_lines, dup_line_chars = _dup_lines(data, offsets, letters)

    first, doc = words.windows(5)
    twice = _duplicated(window_hash(words.code, first, 5), doc)
    first, doc = first[twice], doc[twice]
    shares, repeat = {}, None
    whole = np.maximum(word_chars, 1)
    for k in (5, 8, 10):
        if k > 5:
            inside = first + k <= words.ptr[doc + 1]
            first, doc = first[inside], doc[inside]
            twice = _duplicated(window_hash(words.code, first, k), doc)
            first, doc = first[twice], doc[twice]
        covered = _covered(first, k, len(words.start))
        shares[k] = sums(np.where(covered, of_word, 0), words.ptr) / whole
        if k == 8:
            repeat = sums(covered.astype(np.int64), words.ptr)
    base_failed = (n < 20) | (100 * repeat > 30 * n)
    line_share, symbol_share = dup_line_chars / whole, symbols / whole
    bad = (
        (line_share > limits.dup_lines) | (shares[5] > limits.dup5) | (shares[8] > limits.dup8)
        | (shares[10] > limits.dup10) | (symbol_share > limits.symbols)
    )
    return {
        "n_words": n, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": repeat,
        "base_failed": base_failed, "kept": ~base_failed & ~bad, "dup_line_share": line_share,
        "dup5_share": shares[5], "dup8_share": shares[8], "dup10_share": shares[10], "symbol_share": symbol_share,
    }


def repetition(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts, shares, base_failed and kept.

    Null and empty texts have no words and fail the base rule.  Null and repeated doc_ids are
    passed through, one result per row.  Other columns are ignored.
    """
    def run(batches):
        for part, data, offsets in blocks(batches, "text"):
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), **measure(data, offsets, limits)})

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, SCHEMA)
