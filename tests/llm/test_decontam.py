import random

import pytest

from spanmask.llm.decontam import MASKS, SPAN, leaks

from . import brute
from .conftest import prose, vocabulary


@pytest.fixture(scope="module")
def planted(documents):
    rng, vocab = random.Random(8), vocabulary(900)
    items = [(i, prose(rng, rng.randint(3, 50), vocab)) for i in range(20)] + [(90, None), (91, ""), (None, "a b c d e f")]
    items += [(50, items[7][1]), (51, "short item of six words"), (52, "Yes it is"), (53, "one"), (54, "nine words of an item that may differ once")]
    docs = list(documents)
    for n in range(40):
        words = brute.words(rng.choice(items[:20])[1])
        for _ in range(rng.randint(0, 6)):               # substitutions
            words[rng.randrange(len(words))] = "changed"
        a = rng.randint(0, len(words) // 2)
        docs.append((10_000 + n, prose(rng, 30, vocab) + " " + " ".join(words[a:]).upper() + " " + prose(rng, 20, vocab)))
    docs.append((20_000, "x Short item of six words y"))
    docs += [(20_001 + i, t) for i, t in enumerate([
        "yes  it\nIS", "yes it is so", "one", "one two", "a nine words of an ITEM that can differ once b", "nine words in an item that can differ once", "short item of few words", "short " * 3])]
    docs.append((20_020, "echo " * 3000))
    items.append((55, "echo " * 40))
    return docs, items


def test_brute_force(spark, planted):
    docs, items = planted
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = leaks(df, bench).collect()
    assert {(r.doc_id, r.item_id): (r.n_words, r.n_equal) for r in rows} == brute.leaks(docs, items)
    texts = {**dict(docs)}
    for r in rows:
        a, b = brute.words(texts[r.doc_id], True), brute.words(dict(items)[r.item_id], True)
        same = [x == y for x, y in zip(a[r.doc_start:r.doc_start + r.n_words], b[r.item_start:r.item_start + r.n_words])]
        assert len(same) == r.n_words and sum(same) == r.n_equal


def test_a_full_filter_changes_nothing(spark, planted):
    docs, items = planted
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(leaks(df, bench, filter_bits=12).collect()) == sorted(leaks(df, bench).collect())


def test_every_two_positions_are_ignored_by_some_mask():
    for a in range(SPAN):
        for b in range(SPAN):
            assert any(a not in m and b not in m for m in MASKS)


def test_sf0001(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
    docs, items = [(r.doc_id, r.text) for r in read("documents").collect()], [(r.item_id, r.text) for r in read("benchmark").collect()]
    hit = {r.doc_id for r in leaks(read("documents"), read("benchmark")).collect()}
    grams = {tuple(w[i:i + 8]) for w in (brute.words(t, True) for _, t in items) for i in range(len(w) - 7)}
    assert hit == {d for d, t in docs if any(tuple(w[i:i + 8]) in grams for w in [brute.words(t, True)] for i in range(len(w) - 7))}


def test_empty_and_odd(spark, empty, odd):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta", 5)], "item_id long, text string, seed int")
    assert leaks(empty, bench).collect() == [] and leaks(odd, bench.limit(0)).collect() == []
    assert sorted((r.doc_id, r.item_id) for r in leaks(odd, bench).collect()) == [(2, 1), (4, 1)]
