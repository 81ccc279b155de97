from spanmask.llm.quality import Limits, repetition

from . import brute


def test_counts(docs, documents):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in repetition(docs).collect()}
    assert got == {i: brute.repetition(t) for i, t in documents}


def test_sf0001(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in repetition(df).collect()}
    assert got == {r.doc_id: brute.repetition(r.text) for r in df.collect()}


def test_verdict(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    rows = [(1, clean), (2, (clean + "\n") * 3), (3, " ".join(f"w{i}***" for i in range(60))), (4, "too short"), (5, clean + "\n" + "same line of words\n" * 12)]
    got = {r.doc_id: (r.base_failed, r.kept) for r in repetition(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (False, True) and got[4] == (True, False)
    assert not got[2][1] and not got[3][1] and not got[5][1]
    loose = repetition(spark.createDataFrame(rows, "doc_id long, text string"), Limits(symbols=1.0))
    assert {r.doc_id: r.kept for r in loose.collect()}[3]


def test_empty_and_odd(empty, odd):
    assert repetition(empty).collect() == []
    assert sorted(r.n_words for r in repetition(odd).collect()) == [0, 0, 6, 6, 6, 6]
