"""Token ids of whole texts by a public tokenizer file, at the speed of a table lookup.

Many tokenizers drop white space and never join characters across it,
so the ids of a text are the ids of its words (runs without space or \\x09-\\x0D), one
after the other.  A worker keeps the ids of the words that it has seen, found by their
63-bit hash, up to a bound (then it starts afresh), and hands only new words to the library.

Whether a tokenizer file is of that kind is checked when it is loaded, on texts with all that sets tokenizers apart (case, marks,
scripts, white space at all places).  One that is not gets whole texts, one after the other.
"""

from __future__ import annotations

import os
import re

import numpy as np

from .text import find_words, ragged, sums

U64 = np.uint64
#: Words whose ids a worker keeps at most.
MAX_WORDS = 1_000_000
TABLE_BITS = 21
#: Latin letters, then marks other than apostrophes: tokenizer rules part the two, and each has its own ids.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ž]+)([!-&(-/:-@\[-`{-~]*)")
_END = "</w>"
#: Texts on which the words' ids and the library's are compared when a tokenizer is loaded.
PROBES = (
    "The Cat sat on the mat.", " the cat", "the cat ", "the  cat\n\tsat\r\n\x0bon", "NASA iPhone McDonald's don't I'LL we've", "a", "A", " ", "\n", "x y",
    "naïve café Über straße ÅNGSTRÖM", "e\u0301a\u0308 \u0301x", "Русский текст", "Ελληνικά ΣΑΣ", "漢字かな交じり文 と空白", "한국어 문장", "العربية نص", "हिन्दी पाठ", "ไทย",
    "12345 3.14 1,000 12a3b 0x7f", "e-mail: a.b@c.org, http://x.org/?q=1&r=2", "a_b-c/d\\e (f) [g] {h} <i>", "!!! ??? ... -- ***", "'quoted' \"text\"", "end. Next,then;more",
    "😀 👩‍👩‍👧 ❤️", "a\u00a0b\u2003c\u3000d", "tab\tand\x0cfeed", "word" * 40, "aa aaa aaaa aaaaa", "İstanbul ǅ ŉ ſ", "snake_case camelCase PascalCase", "x\u200by",
)
_encoders: dict[str, "Encoder"] = {}


class HashTable:
    """64-bit hash -> small number, probed for whole arrays at once."""

    def __init__(self, bits: int):
        self.mask = U64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.values = np.zeros(1 << bits, dtype=np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The numbers; -1 where there is none."""
        out = np.full(len(keys), -1, dtype=np.int64)
        at = keys & self.mask
        have = self.keys[at]
        hit = have == keys
        out[hit] = self.values[at[hit]]
        left = np.flatnonzero(~hit & (have != 0))
        while len(left):
            at = (at[left] if len(at) != len(left) else at) + U64(1) & self.mask
            have = self.keys[at]
            hit = have == keys[left]
            out[left[hit]] = self.values[at[hit]]
            more = ~hit & (have != 0)
            left, at = left[more], at[more]
        return out

    def add(self, keys: np.ndarray, first: int) -> None:
        """Give distinct new keys the numbers first, first + 1, ..."""
        self._put(keys, np.arange(first, first + len(keys), dtype=np.int32))

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        at = keys & self.mask
        while len(keys):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[free]
            won = self.keys[at] == keys
            self.values[at[won]] = values[won]
            keys, values, at = keys[~won], values[~won], at[~won] + U64(1) & self.mask

    def room(self, n: int) -> None:
        """Make sure that n keys fill no more than three quarters."""
        if 4 * n > 3 * len(self.keys):
            keys, values = self.keys, self.values
            self.__init__(int(2 * n).bit_length())
            used = keys != 0
            self._put(keys[used], values[used])


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(_END)]] = True
        self.width = max(1, int(len(self.ends) - 1).bit_length())
        self._reset()
        self.by_words = self._parted()
        self._reset()

    def _parted(self) -> bool:
        """Whether the ids of a text are those of its words, and words have the same ids in any company and case."""
        want = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in PROBES]
        data = "".join(PROBES).encode()
        offsets = np.cumsum([0] + [len(t.encode()) for t in PROBES])
        ids, counts = self._from_words(np.frombuffer(data, dtype=np.uint8), offsets)
        return counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]

    def _from_texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        return self._each([raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])

    def _reset(self):
        self.table, self.known = HashTable(TABLE_BITS), 0
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.first, self.count = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids per word), by one call for each."""
        got = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
        return np.array([i for ids in got for i in ids], dtype=np.uint32), np.array([len(ids) for ids in got], dtype=np.int64)

    def _many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of lower-case words of letters: many in one call, parted after each word-end token."""
        out, sizes = [], []
        for at in range(0, len(words), 4096):
            some = words[at:at + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            stop = np.flatnonzero(self.ends[ids]) + 1
            ids, size = (ids, np.diff(stop, prepend=0)) if len(stop) == len(some) else self._each(some)
            out.append(ids)
            sizes.append(size)
        return np.concatenate(out), np.concatenate(sizes)

    def _store(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray):
        """Keep the ids of new words, one after the other in ``ids``."""
        n, end = self.known + len(hashes), self.used + len(ids)
        self.flat, self.first, self.count = _room(self.flat, end), _room(self.first, n), _room(self.count, n)
        self.flat[self.used:end] = ids
        self.first[self.known:n] = self.used + np.cumsum(sizes) - sizes
        self.count[self.known:n] = sizes
        self.table.room(n)
        self.table.add(hashes, self.known)
        self.used, self.known = end, n

    def _slots(self, words: list[str], ask) -> np.ndarray:
        """The numbers of words; those not known yet are asked for."""
        data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
        code = _key(find_words(data, np.array([0, len(data)])).code)
        slot = self.table.find(code)
        new = np.flatnonzero(slot < 0)
        if len(new):
            hashes, at = np.unique(code[new], return_index=True)
            self._store(hashes, *ask([words[i] for i in new[at].tolist()]))
            slot[new] = self.table.find(code[new])
        return slot

    def _learn(self, hashes: np.ndarray, words: list[str]):
        match = [_PLAIN.fullmatch(w) for w in words]
        plain = np.array([m is not None for m in match], dtype=bool)
        if plain.any():
            # Letters and marks are looked up apart, then joined; a word that is its own letters is known by then.
            stem = self._slots([m.group(1).lower() for m in match if m], self._many)
            tails = [m.group(2) for m in match if m]
            has = np.array([bool(t) for t in tails], dtype=bool)
            parts = np.stack([stem, np.zeros_like(stem)], axis=1)
            if has.any():
                parts[has, 1] = self._slots([t for t in tails if t], self._each)
            size = self.count[parts]
            size[~has, 1] = 0
            new = self.table.find(hashes[plain]) < 0
            parts, size = parts[new], size[new]
            ids = self.flat[ragged(self.first[parts].reshape(-1), size.reshape(-1))]
            self._store(hashes[plain][new], ids, size.sum(axis=1))
        if not plain.all():
            odd = np.flatnonzero(~plain)
            odd = odd[self.table.find(hashes[odd]) < 0]      # marks alone may be known as tails
            self._store(hashes[odd], *self._each([words[i] for i in odd.tolist()]))

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text) of a block of UTF-8 texts; ``end`` follows each text if given."""
        ids, counts = (self._from_words if self.by_words else self._from_texts)(data, offsets)
        if end is not None:
            ids = np.insert(ids, np.cumsum(counts), np.uint32(end))
            counts = counts + 1
        return ids, counts

    def _from_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.known > MAX_WORDS:
            self._reset()
        words = find_words(data, offsets)
        code = _key(words.code)
        slot = self.table.find(code)
        new = np.flatnonzero(slot < 0)
        if len(new):
            hashes, at = np.unique(code[new], return_index=True)
            at, raw = new[at], data.tobytes()
            self._learn(hashes, [raw[a:b].decode() for a, b in zip(words.start[at].tolist(), words.end[at].tolist())])
            slot[new] = self.table.find(code[new])
        sizes = self.count[slot]
        ids = self.flat[ragged(self.first[slot], sizes)]
        return ids, sums(sizes, words.ptr)


def _key(code: np.ndarray) -> np.ndarray:
    """A word's hash as a key of the table, where 0 stands for a free place."""
    return code | U64(1) << U64(63)


def _room(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    out = np.zeros(max(n, 2 * len(a)), dtype=a.dtype)
    out[:len(a)] = a
    return out


def encoder(path: str) -> Encoder:
    """The encoder of this worker process for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
