"""Long cells cut into pieces: equal to the scan of whole cells for every size of a piece."""

import random

import pytest
from pyspark.sql import functions as F

from spanmask import anonymize, scan
from spanmask.functions.recognizers import BUILTIN, EMAIL, IP_ADDRESS, PHONE, SECRET, Recognizer
from spanmask.operators.chunked import text_pieces

ALL = list(BUILTIN.values())
BITS = ["a@b.co", "x.y", "@", ".", ",", ", ", "\n", "é", "é", "́", "😀", "10.0.0.1", "1.2.3.4.5.6.7.8", "4111111111111111", "411111", "+1 (555) 123-4567",
        "+1 (", "deadbeef" * 6, "dead", "https://a.b/c?d", "://", " ", "_", "ß", "-", " ", "a"]


def random_texts(n, size, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randrange(size))) for _ in range(n)]


def rows(df):
    return sorted(df.collect(), key=repr)


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 16, 61, 200, 100_000])
def test_equal_to_the_whole_scan(spark, chunk):
    texts = random_texts(150, 60, chunk) + ["", None]
    df = spark.createDataFrame([(i, t, texts[-i - 1]) for i, t in enumerate(texts)], "id int, t string, `u.v` string").coalesce(2)
    whole = scan(df, exclude=["id"], recognizers=ALL)
    cut = scan(df, exclude=["id"], recognizers=ALL, strategy="chunked", key="id", chunk=chunk)
    assert cut.schema == whole.schema
    assert rows(cut) == rows(whole)


@pytest.mark.parametrize("recs", [[EMAIL], [IP_ADDRESS], [PHONE, SECRET], []])
def test_pieces_make_the_text(spark, recs):
    texts = random_texts(100, 80, 9) + ["", "f" * 500, "\n" * 100, "f" * 50 + "," + "f" * 50]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for chunk in (1, 5, 32):
        for t, pieces in df.select("t", text_pieces(F.col("t"), recs, chunk)).collect():
            assert "".join(p.text[p.lead:] for p in pieces) == t
            at = 0
            for p in pieces:
                assert p["from"] == at and p.lead == (1 if at else 0) and (not at or p.text[0] == t[at - 1])
                at += len(p.text) - p.lead


def test_a_long_cell_is_spread(spark):
    text = "some prose, a@b.co and more é prose.\n" * 20_000
    df = spark.createDataFrame([(1, text), (2, "c@d.co")], "id int, t string")
    (n,) = df.where("id = 1").select(F.size(text_pieces(F.col("t"), ALL, 10_000))).first()
    assert n == len(text) // 10_000
    whole, cut = scan(df, exclude=["id"]), scan(df, exclude=["id"], strategy="chunked", key="id", chunk=10_000, parallelism=16)
    assert rows(cut) == rows(whole)
    assert rows(anonymize(cut)) == rows(anonymize(whole))


def test_without_a_key_and_with_equal_rows(spark):
    df = spark.createDataFrame([("a@b.co, " * 50,)] * 3 + [("10.0.0.1",), (None,)], "t string")
    assert rows(scan(df, strategy="chunked", chunk=20)) == rows(scan(df))


def test_known_columns_layouts_and_empty_table(spark):
    df = spark.createDataFrame([(1, "Ann", "a@b.co, " * 20), (2, "Bo", "x")], "id int, name string, t string")
    for layout in ("nested", "flat"):
        plan = {"exclude": ["id"], "known": ["name"], "layout": layout}
        assert rows(scan(df, strategy="chunked", key="id", chunk=9, **plan)) == rows(scan(df, **plan))
    assert scan(df.limit(0), exclude=["id"], strategy="chunked", chunk=9).count() == 0
    assert scan(df, exclude=["id", "t"], known=["name"], strategy="chunked", chunk=9).count() == 2


def test_refuses_what_it_cannot_cut(spark):
    df = spark.createDataFrame([("a",)], "t string")
    with pytest.raises(ValueError, match="alphabet"):
        scan(df, recognizers=[Recognizer("X", "x+", 1.0)], strategy="chunked")
    with pytest.raises(ValueError, match="plain recognisers"):
        scan(df, strategy="chunked", min_score=0.5)
    with pytest.raises(ValueError, match="one character"):
        scan(df, strategy="chunked", chunk=0)


def test_pieces_are_scanned_behind_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a@b.co, " * 50)], "id int, t string")
    cut = scan(df, exclude=["id"], strategy="chunked", key="id", chunk=20).select("id", F.inline("pii_analysis_result.analysis_results.t"))
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression")
    assert "EMAIL_ADDRESS" in above and "EMAIL_ADDRESS" not in below.split("LocalRelation")[0].split("LogicalRDD")[0]
