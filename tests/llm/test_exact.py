import hashlib
import random

import pytest
from pyspark.sql import functions as F

from spanmask.llm.exact import exact_duplicates


def brute(rows, normalise=lambda t: t, largest=True):
    """(doc_id, keep_id, group_size, sha) of each row and the number of kept rows of each text."""
    groups = {}
    for i, t in rows:
        groups.setdefault(normalise(t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def check(df, rows, **options):
    got = exact_duplicates(df, **options).collect()
    norm = (lambda t: t.lower()) if "normalise" in options else (lambda t: t)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(rows, norm, options.get("keep") != "smallest")
    kept = {}
    for r in got:
        if r.kept:
            kept.setdefault(r.text_sha256, []).append(r)
    assert set(kept) == {r.text_sha256 for r in got} and all(len(v) == 1 and v[0].doc_id == v[0].keep_id for v in kept.values())


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_hot_texts_in_pieces(spark, keep):
    rng = random.Random(4)
    rows = [(i, f"common head of thirty two characters and more {i % 40 if i % 3 else i}") for i in range(900)]
    rows += [(1000 + i, "one text of a third of all rows " * 50) for i in range(600)] + [(5000 + i, None if i % 2 else "") for i in range(90)]
    rows += [(None, "no id")] * 40 + [(7, "the same row")] * 300
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("code", "salt", "head", "pieces", "size")}).repartition(5)
    check(df, rows, keep=keep)


def test_documents_and_normalisation(docs, documents, odd, empty):
    check(docs, documents)
    check(docs, [(i, "".join(c.lower() if c.isascii() else c for c in t or "")) for i, t in documents],
          normalise=lambda c: F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    check(odd, rows)
    assert exact_duplicates(empty).collect() == []
    with pytest.raises(ValueError):
        exact_duplicates(empty, keep="first")


def test_plan_is_native_and_ranged(docs, spark):
    df = exact_duplicates(docs)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
