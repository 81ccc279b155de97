import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spanmask.llm import tokens
from spanmask.llm.packing import Slots, pack_documents, patterns
from spanmask.llm.text import utf8
from spanmask.llm.wavelet import WaveletMatrix, document_digests, read_shards, token_output, write_shards

from . import brute

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def encode(texts, end=None):
    return tokens.encoder(PATH).encode(*utf8(pa.array(texts, pa.string())), end)


def test_encoder_equals_library(library, documents):
    odd = ["a\x1cb\x1d c", "İstanbul ŞşŒ ΑΣ Σ. don't it's 12a3 é́ e\u0301x\u00a0z\u3000w ǅ ŉ K Ω", "A.B,C!!x; y:ſ ß ẞ", "\u0301 x", "x\u200by", "I'll 'S''", "'re", "a<|endoftext|>b <|startoftext|>"]
    texts = [t for _, t in documents] + odd
    ids, counts = encode(texts, 1)
    want = [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(), max_size=4))
def test_encoder_on_any_text(texts):
    library = tokens.encoder(PATH).tokenizer
    ids, _ = encode(texts)
    assert ids.tolist() == sum((library.encode(t, add_special_tokens=False).ids for t in texts), [])


def test_encoder_starts_afresh(monkeypatch):
    enc = tokens.Encoder(PATH)
    monkeypatch.setattr(tokens, "MAX_WORDS", 5)
    for text in ("alpha beta gamma", "delta epsilon zeta", "alpha theta iota kappa"):
        ids, _ = enc.encode(*utf8(pa.array([text])))
        assert ids.tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
    assert enc.known == 4
    big = ' '.join(f'word{i} w{i}.' for i in range(40_000)) + ' x' * 5
    monkeypatch.setattr(tokens, 'TABLE_BITS', 10)
    small = tokens.Encoder(PATH)                          # a block that outgrows the table
    ids, _ = small.encode(*utf8(pa.array([big])))
    assert ids.tolist() == enc.tokenizer.encode(big, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=20))
def test_patterns_use_each_length_once(histogram):
    packs = patterns(histogram, 32)
    used = {}
    for count, pack in packs:
        assert count > 0 and sum(pack) <= 32
        for length in pack:
            used[length] = used.get(length, 0) + count
    assert used == histogram
    slots, seen = Slots(packs), set()
    for length, n in histogram.items():
        seq, off = slots.place(np.full(n, length), np.arange(n))
        for s, o in zip(seq.tolist(), off.tolist()):
            cells = {(s, o + i) for i in range(length)}
            assert not cells & seen
            seen |= cells


def test_pack_documents(docs, documents, library):
    want = {i: ids for (i, _), (ids, _) in zip(documents, brute.token_digests(documents, library))}
    rows = pack_documents(docs, PATH, size=128, keep_ids=True).collect()
    assert sum(r.length for r in rows) == sum(map(len, want.values()))
    places = {}
    for r in rows:
        part = want[r.doc_id][r.start:r.start + r.length]
        assert r.ids == part.tolist() and r.ids_crc32 == brute.zlib.crc32(part.tobytes()) and r.doc_tokens == len(want[r.doc_id])
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 128
    assert sorted(places) == list(range(len(places)))


def test_token_output(docs, documents, library, scratch, spark):
    write_shards(docs, scratch + "/shards", PATH, shard_bytes=20_000)
    rows = sorted(documents)
    want = brute.token_digests(rows, library)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in document_digests(spark, scratch + "/shards").collect()}
    start, expected = 0, {}
    for (i, _), (ids, crc) in zip(rows, want):
        expected[i] = (start, len(ids), crc)
        start += len(ids)
    assert got == expected
    shards = read_shards(spark, scratch + "/shards").orderBy("shard").collect()
    assert len(shards) > 1
    flat = np.concatenate([WaveletMatrix(s.n_tokens, s.planes, s.ones).tokens() for s in shards])
    assert flat.tolist() == np.concatenate([ids for ids, _ in want]).tolist()


def test_empty_and_odd(empty, odd, library):
    assert pack_documents(empty, PATH).collect() == [] and token_output(empty, PATH).collect() == []
    n = len(library.encode("alpha beta gamma delta epsilon zeta", add_special_tokens=False).ids) + 1
    assert sorted(r.length for r in pack_documents(odd, PATH).collect()) == sorted([n] * 4 + [1] * 2)
    rows = sorted((r.start, r.doc_id, r.n_tokens) for r in token_output(odd, PATH).collect())
    assert rows == [(0, None, 1), (1, None, n), (n + 1, 2, n), (2 * n + 1, 4, n), (3 * n + 1, 4, n), (4 * n + 1, 9, 1)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 49407), min_size=1, max_size=300), st.data())
def test_wavelet_matrix(ids, data):
    a = np.array(ids * data.draw(st.sampled_from([1, 40])), dtype=np.uint32)
    w = WaveletMatrix(len(a), *WaveletMatrix.build(a, 16))
    assert w.tokens().tolist() == a.tolist()
    i, j = sorted(data.draw(st.tuples(st.integers(0, len(a)), st.integers(0, len(a)))))
    token = int(a[data.draw(st.integers(0, len(a) - 1))])
    assert w.token(j - 1) == a[j - 1] if j else True
    assert w.count(token, i, j) == (a[i:j] == token).sum()
    where = np.flatnonzero(a == token)
    k = data.draw(st.integers(0, len(where) - 1))
    assert w.find(token, k) == where[k]
    with pytest.raises(IndexError):
        w.find(token, len(where))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_every_tokenizer_file_equals_the_library(name, documents):
    path = public_tokenizers.path(name)
    library, enc = Tokenizer.from_file(path), tokens.Encoder(path)
    assert enc.by_words == (name == "word_bpe_49k.json")
    texts = [t for _, t in documents] + [*tokens.PROBES, "The Cat sat on the mat.", "  Two  spaces ", "Case CASE case"]
    ids, counts = enc.encode(*utf8(pa.array(texts, pa.string())), 1)
    want = [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_tasks_are_bounded(spark, docs, documents, library, scratch):
    write_shards(docs, f"{scratch}/few", PATH, shard_bytes=100, max_tasks=3)
    assert read_shards(spark, f"{scratch}/few").count() <= 3
    rows = sorted(document_digests(spark, f"{scratch}/few").collect())
    want, start = [], 0
    for (i, _), (ids, crc) in zip(sorted(documents, key=lambda d: d[0]), brute.token_digests(sorted(documents, key=lambda d: d[0]), library)):
        want.append((i, start, len(ids), crc))
        start += len(ids)
    assert [tuple(r) for r in rows] == want
