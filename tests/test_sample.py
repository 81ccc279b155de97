"""Samples, the column plan from evidence, and distinct-value sketches."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from spanmask import scan
from spanmask.functions.recognizers import EMAIL, PHONE
from spanmask.operators import sample as S
from spanmask.operators.advise import advise_columns, plan_from, wilson
from spanmask.operators.distinct import distinct_parts, distinct_values, merge_distinct
from spanmask.operators.sample import DIGEST, bottom_k, merge_samples


def digest(key):
    return hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()


def test_same_rows_for_every_partitioning(spark):
    df = spark.range(3000).withColumn("t", F.concat(F.lit("x"), "id"))
    want = sorted(range(3000), key=digest)[:200]
    for parts in (1, 7, 40):
        got = bottom_k(df.repartition(parts, F.rand()), "id", 200).collect()
        assert sorted(r.id for r in got) == sorted(want) and all(r[DIGEST] == digest(r.id) for r in got)
    assert bottom_k(df, "id", 5000).count() == 3000 and bottom_k(df.limit(0), "id", 5).count() == 0
    with pytest.raises(ValueError):
        bottom_k(df, "id", 0)


def test_only_the_sample_leaves_the_scan(spark):
    df = spark.range(100_000, numPartitions=4)
    kept = bottom_k(df, "id", 100, rows=100_000)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and "< 0" in plan            # a bound on the digest, below the ordering
    assert kept.count() == 100


def test_bound_is_widened(spark, monkeypatch):
    monkeypatch.setattr(S, "_bound", lambda rows, wanted, real=S._bound: real(rows, wanted / 1000))
    got = bottom_k(spark.range(2000), "id", 50).collect()
    assert sorted(r.id for r in got) == sorted(sorted(range(2000), key=digest)[:50])


def test_extend_and_merge(spark):
    df = spark.range(1000)
    order = sorted(range(1000), key=digest)
    more = bottom_k(df, "id", 30, after=digest(order[69])).collect()
    assert {r.id for r in more} == set(order[70:100])
    a, b = bottom_k(df.where("id % 3 = 0"), "id", 40), bottom_k(df.where("id % 3 > 0"), "id", 40)
    assert {r.id for r in merge_samples(a, b, 40).collect()} == set(order[:40])


def test_null_and_repeated_keys(spark):
    rows = [(None, "a"), (None, "b"), (1, "c"), (1, "c"), (1, "d"), (2, "e")]
    df = spark.createDataFrame(rows, "k int, v string")
    for k in range(1, 7):
        picks = {tuple(sorted((r.v for r in bottom_k(df.repartition(3, F.rand()), "k", k).collect()))) for _ in range(2)}
        assert len(picks) == 1 and len(picks.pop()) == k


def test_wilson():
    assert wilson(0, 0) == (0.0, 1.0)
    low, high = wilson(0, 1000, 1.96)
    assert low == 0 and math.isclose(high, 1.96 ** 2 / (1000 + 1.96 ** 2))
    low, high = wilson(30, 100, 1.96)
    assert math.isclose(low, 0.2189, abs_tol=1e-4) and math.isclose(high, 0.3958, abs_tol=1e-4)


@pytest.fixture(scope="module")
def mixed(spark):
    df = spark.range(6000).select(
        "id", F.lit("plain words").alias("clean"), F.concat(F.lit(" u"), "id", F.lit("@b.org")).alias("mail"),
        F.concat(F.lit("write to u"), "id", F.lit("@b.org now")).alias("note"),
        F.when(F.col("id") % 50 == 7, "at a@b.co").otherwise("-").alias("some"),        # 2 %
        F.when(F.col("id") % 105 == 7, "at a@b.co").otherwise("-").alias("edge"),       # just under 1 %: needs every row
        F.lit(None).cast("string").alias("nothing"), F.lit("  ").alias("blank"), F.lit(3).alias("number"))
    return df.cache()


def test_advice(mixed):
    rows = {r.column: r for r in advise_columns(mixed, "id", recognizers=[EMAIL, PHONE]).collect()}
    assert {c: r.advice for c, r in rows.items()} == {
        "clean": "exclude", "mail": "known", "note": "scan", "some": "scan", "edge": "exclude", "nothing": "exclude", "blank": "exclude"}
    assert rows["note"].sampled == 512 and rows["clean"].sampled == 2048 and rows["edge"].sampled == 6000
    assert (rows["edge"].filled, rows["edge"].hits) == (6000, 58) and rows["nothing"].filled == 0
    for r in rows.values():
        assert r.hit_low <= r.hits / max(r.filled, 1) <= r.hit_high
    plan = plan_from(advise_columns(mixed, "id", ["mail", "note", "clean"], [EMAIL]))
    assert plan == {"exclude": ["clean"], "known": ["mail"]}
    assert scan(mixed, recognizers=[EMAIL], strings_only=True, **plan).schema["pii_analysis_result"].dataType["known_pii_columns"].dataType.fieldNames() == ["mail"]


def test_advice_is_repeatable_and_defined_on_empty_tables(mixed):
    a, b = (sorted(map(tuple, advise_columns(x, "id", ["some", "note"], [EMAIL]).collect())) for x in (mixed, mixed.repartition(9, F.rand())))
    assert a == b
    assert {r.advice for r in advise_columns(mixed.limit(0), "id").collect()} == {"exclude"}
    with pytest.raises(ValueError):
        advise_columns(mixed, "id", low=0.9, high=0.5)


def _addresses(spark, n, copies=3):
    texts = spark.range(n * copies).select("id", F.concat(F.lit("to u"), F.col("id") % n, F.lit("@b.org or u"), F.col("id") % n, F.lit("@b.org")).alias("t"))
    return scan(texts, exclude=["id"], recognizers=[EMAIL])


def test_distinct_values(spark):
    (r,) = distinct_values(_addresses(spark, 400)).collect()
    assert (r.column, r.entity_type, r.distinct_values, r.exact) == ("t", "EMAIL_ADDRESS", 400, True)
    (r,) = distinct_values(_addresses(spark, 20_000, 1), k=900).collect()
    assert not r.exact and abs(r.distinct_values - 20_000) < 4 / math.sqrt(900) * 20_000
    assert distinct_values(scan(spark.createDataFrame([(1, None), (2, "")], "id int, t string"), exclude=["id"])).collect() == []


def test_sketches_add_up(spark):
    whole = _addresses(spark, 5000, 1)
    parts = [distinct_parts(whole.where(F.col("id") % 3 == i), 500) for i in range(3)]
    merged = merge_distinct(parts[0].unionByName(parts[1]).unionByName(parts[2]), 500).collect()
    assert merged == distinct_values(whole, 500).collect()


def test_tasks_cut_before_the_shuffle(spark):
    plan = distinct_parts(_addresses(spark, 10))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
