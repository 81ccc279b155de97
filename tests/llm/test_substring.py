import pytest

from spanmask.llm.substring import cut_repeats

from . import brute


def as_dict(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("span,kmer", [(50, 10), (12, 4), (20, 20)])
def test_brute_force(docs, documents, span, kmer):
    assert as_dict(cut_repeats(docs, span=span, kmer=kmer, texts=False)) == brute.cut_repeats(documents, span)


def test_sf0001_and_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = cut_repeats(df).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == brute.cut_repeats([(r.doc_id, r.text) for r in df.collect()])
    for r in rows:
        assert brute.hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_windows_that_overlap_and_periodic_texts(spark):
    import random

    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_dict(cut_repeats(df, span=6, kmer=2)) == brute.cut_repeats(rows, 6)


def test_empty_and_odd(empty, odd):
    assert cut_repeats(empty).collect() == []
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in cut_repeats(odd, span=5, kmer=2).collect()), key=str)
    assert got == sorted([(None, 6, 0), (None, 0, 0), (4, 6, 6), (4, 6, 6), (2, 6, 0), (9, 0, 0)], key=str)
