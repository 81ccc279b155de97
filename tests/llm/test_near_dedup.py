import time

import numpy as np

from spanmask.llm.components import components
from spanmask.llm.near_dedup import near_duplicates, sketch

from . import brute


def as_dict(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_brute_force(docs, documents):
    got = as_dict(near_duplicates(docs))
    assert got == brute.near_duplicates(documents)


def test_blocks_smaller_than_a_bucket(docs, documents):
    assert as_dict(near_duplicates(docs, block=3)) == brute.near_duplicates(documents)


def test_sf0001(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert as_dict(near_duplicates(df)) == brute.near_duplicates(rows)


def test_large_group_of_near_copies(spark):
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(500):
        copy = list(base)
        for at in rng.integers(0, 300, 4):
            copy[at] = f"x{rng.integers(1 << 30)}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_dict(near_duplicates(df)) == brute.near_duplicates(rows)


def test_empty_and_odd(empty, odd):
    assert near_duplicates(empty).collect() == []
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(odd).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (None, 0, None, True), (4, 2, 2, False), (4, 2, 2, False), (2, 2, 2, True), (9, 0, 9, True)], key=str)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    sets = [rng.integers(1, 1 << 60, n, dtype=np.uint64) for n in (1, 2, 7, 500)]
    a = np.unique(rng.integers(1, 1 << 60, 1000, dtype=np.uint64))
    b = np.concatenate([a[:900], rng.integers(1, 1 << 60, 100, dtype=np.uint64)])
    sets += [a, b]
    code, ptr = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets])
    s = sketch(code, ptr, 1024)
    assert (s != ~np.uint64(0)).all()
    assert abs((s[-1] == s[-2]).mean() - 900 / (len(a) + 100)) < 0.05


def test_components_of_a_chain_and_a_star(spark):
    rows = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 130)] + [(129, 200), (300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 130)}, 200: 100}


def template_family(n, shared=250, own=50, seed=5):
    """Pages of one template, alike at 0.71; every 40th has a near copy."""
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        words = [f"c{j}" for j in range(shared)] + [f"w{i}x{j}" for j in range(own)]
        rows.append((i, " ".join(words)))
        if i % 40 == 7:
            words[int(rng.integers(0, len(words)))] = "changed"
            rows.append((100_000 + i, " ".join(words)))
    return rows


def test_template_family_against_brute_force(spark):
    rows = template_family(240) + [(500_000 + i, " ".join(f"s{j}" for j in range(60)) + f" t{i % 9} u{i % 4}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute.near_duplicates(rows)
    assert as_dict(near_duplicates(df)) == want == as_dict(near_duplicates(df, block=16))
    low = brute.near_duplicates(rows, num=80)
    assert as_dict(near_duplicates(df, num=80, bands=27, rows=4)) == low


def test_template_family_grows_in_proportion(spark):
    rows = template_family(6000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    began = time.time()
    got = as_dict(near_duplicates(df))
    assert time.time() - began < 120
    assert {i for i, (_, _, kept) in got.items() if not kept} == {i for i, _ in rows if i >= 100_000}
    assert all(got[i][1] == i - 100_000 for i, _ in rows if i >= 100_000)
