"""Words of many texts at once, for use inside Arrow tasks.

Texts are handled as arrays of code points.  A word is a run of letters; hashes are 64 bits, over the characters as a
dictionary compares them: letters folded to lower case, a run of white space as one space.  One prefix sum gives
the hash of any stretch of a text, also with one character left out.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POINTS = 0x110000
#: Characters that are looked at together.
BLOCK_CHARS = 1 << 20


@lru_cache(maxsize=1)
def character_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is a letter, folded character, is white space) by code point."""
    letters, space = np.zeros(_POINTS, dtype=bool), np.zeros(_POINTS, dtype=bool)
    fold = np.arange(_POINTS, dtype=np.uint32)
    low, high = "".join(map(chr, range(0xD800))), "".join(map(chr, range(0xE000, _POINTS)))
    for text, first in ((low, 0), (high, 0xE000)):
        for m in regex.finditer(r"\p{L}+", text):
            letters[first + m.start():first + m.end()] = True
        for m in regex.finditer(r"\p{L}", text):
            lower = m.group().lower()
            if lower != m.group() and len(lower) == 1:
                fold[ord(m.group())] = ord(lower)
        for m in regex.finditer(r"\s|[\x1c-\x1f]", text):
            space[first + m.start()] = m.group().isspace()
    return letters, fold, space


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    return np.random.default_rng(20250117).integers(1, 1 << 63, 1 << 12, dtype=np.uint64) * U64(2) + U64(1)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n + 1, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


class WordTexts:
    """The words of a list of texts: ``start`` and ``end`` in their text, ``doc``, and hashes of stretches of words."""

    def __init__(self, texts: list[str]):
        letters, fold, space = character_tables()
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        first = np.cumsum(lengths) - lengths
        n = len(codes)
        edge = np.zeros(n + 1, dtype=bool)
        edge[first] = True
        letter, white = letters[codes], space[codes]
        joins = np.zeros(n, dtype=bool)
        joins[1:] = letter[1:] & letter[:-1] & ~edge[1:n]
        start = np.flatnonzero(letter & ~joins)
        last = np.zeros(n, dtype=bool)
        last[:-1] = joins[1:]
        end = np.flatnonzero(letter & ~last) + 1
        keep = np.ones(n, dtype=bool)
        keep[1:] = ~(white[1:] & white[:-1] & ~edge[1:n])
        kept = np.where(white, 32, fold[codes])[keep].astype(np.uint64)
        at = np.cumsum(keep)                             # characters kept up to and with this one
        self.doc = np.searchsorted(first, start, side="right") - 1
        self.start, self.end = start - first[self.doc], end - first[self.doc]
        self.words = np.bincount(self.doc, minlength=len(texts)) if len(start) else np.zeros(len(texts), dtype=np.int64)
        self.left = np.cumsum(self.words)[self.doc] - np.arange(len(start))      # words from this one to the end of its text
        self.low, self.high = at[start] - 1, at[end - 1]     # in the kept characters
        m = len(kept)
        table = _codes()
        value = table[(kept & U64(0xFFF)).astype(np.int64)] + (kept >> U64(12)) * U64(0xD1342543DE82EF95)
        self._inverse = _powers(_BASE_INV, m)
        self._prefix = np.zeros(m + 1, dtype=np.uint64)
        np.cumsum(value * _powers(_BASE, m)[:m], out=self._prefix[1:])

    def hash(self, word: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Hash of the text from the start of each word to the end of word ``to``."""
        low, high = self.low[word], self.high[to]
        return mix((self._prefix[high] - self._prefix[low]) * self._inverse[low] + (high - low).astype(np.uint64))

    def deletions(self, word: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``word``, hash) of each stretch with one of its characters left out, for every character."""
        low, high = self.low[word], self.high[to]
        n = high - low
        row = np.repeat(np.arange(len(word)), n)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        rest = (self._prefix[high[row]] - self._prefix[k + 1]) * U64(_BASE_INV)
        return row, mix((self._prefix[k] - self._prefix[low[row]] + rest) * self._inverse[low[row]] + (n[row] - 1).astype(np.uint64))


def text_blocks(texts: list, limit: int = BLOCK_CHARS):
    """(first index, texts) in blocks of about ``limit`` characters, whole texts; nulls as empty ones."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > limit:
            yield at, [x or "" for x in texts[at:i]]
            at, size = i, 0
        size += len(t or "")
    if at < len(texts):
        yield at, [x or "" for x in texts[at:]]
