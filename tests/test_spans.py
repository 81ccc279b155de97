"""Span detection on edge rows."""

import itertools
import time

import re

import pytest

from pyspark.sql import functions as F

from spanmask import detect, get_recognizers
from spanmask.functions.recognizers import BUILTIN, Recognizer
from spanmask.functions.spans import detect_hits

EMAIL = BUILTIN["EMAIL_ADDRESS"]


def spans_of(spark, texts, recs=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    rows = df.select("id", detect(F.col("t"), recs).alias("s")).orderBy("id").collect()
    return [[(x.entity_type, x.start, x.end) for x in r.s] for r in rows]


def test_edges(spark):
    texts = [
        None,                                   # null -> empty
        "",                                     # empty
        "a@b.co is first",                      # match at start
        "ends with a@b.co",                     # match at end
        "x@y.org z@w.net",                      # two, space between
        "same a@b.co and a@b.co",               # same value twice
        "é café c@d.io",                        # accented text before
        "😀😀 e@f.de",                          # characters beyond the BMP before
        "no hit here",
    ]
    got = spans_of(spark, texts, [EMAIL])
    assert got[0] == [] and got[1] == [] and got[8] == []
    assert got[2] == [("EMAIL_ADDRESS", 0, 6)]
    assert got[3] == [("EMAIL_ADDRESS", 10, 16)]
    assert got[4] == [("EMAIL_ADDRESS", 0, 7), ("EMAIL_ADDRESS", 8, 15)]
    assert got[5] == [("EMAIL_ADDRESS", 5, 11), ("EMAIL_ADDRESS", 16, 22)]
    assert got[6] == [("EMAIL_ADDRESS", 7, 13)]
    assert got[7] == [("EMAIL_ADDRESS", 3, 9)]   # code points, not UTF-16 units


def test_offsets_match_python_on_documents(spark):
    """Every hit equals the substring at its offsets, and Python's re finds
    the same spans for patterns without word boundaries."""
    from conftest import SF001

    recs = [BUILTIN[n] for n in ("EMAIL_ADDRESS", "PHONE_NUMBER", "SECRET_TOKEN")]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = docs.select("doc_id", "text", detect_hits(F.col("text"), recs).alias("h")).collect()
    n = 0
    for r in rows:
        want = sorted((rec.entity_type, m.start(), m.end()) for rec in recs
                      for m in re.finditer(rec.pattern, r.text))
        got = sorted((h.entity_type, h.start, h.end) for h in r.h)
        assert got == want
        for h in r.h:
            assert r.text[h.start:h.end] == h.text
        n += len(got)
    assert n == 12 + 19 + 13


def test_card_luhn(spark):
    valid, invalid = "4111111111111111", "4111111111111112"
    got = spans_of(spark, [f"pay {valid} or {invalid}"], [BUILTIN["CREDIT_CARD"]])
    assert got == [[("CREDIT_CARD", 4, 20)]]
    got = spans_of(spark, [f"pay {valid} or {invalid}"], [BUILTIN["CREDIT_CARD"].without_validator()])
    assert len(got[0]) == 2


def test_overlapping_detections_kept(spark):
    digits = Recognizer("DIGIT_RUN", "[0-9]{6,}", 0.3)
    got = spans_of(spark, ["card 4111111111111111 end"], [BUILTIN["CREDIT_CARD"], digits])
    assert got == [[("CREDIT_CARD", 5, 21), ("DIGIT_RUN", 5, 21)]]


def test_non_string_column_is_cast(spark):
    df = spark.createDataFrame([(4111111111111111,)], "n long")
    r = df.select(detect(F.col("n"), [BUILTIN["CREDIT_CARD"]]).alias("s")).first()
    assert [(x.start, x.end) for x in r.s] == [(0, 16)]


def test_zero_width_pattern_rejected():
    import pytest

    with pytest.raises(ValueError):
        Recognizer("BAD", "x*", 0.1)


def test_get_recognizers():
    assert [r.entity_type for r in get_recognizers()] == [
        "EMAIL_ADDRESS", "IP_ADDRESS", "CREDIT_CARD", "PHONE_NUMBER", "SECRET_TOKEN"]
    assert len(get_recognizers("ALL")) == 6


def test_columns_of_two_tables_keep_their_own_spans(spark):
    a = spark.createDataFrame([(1, "mail a@b.co")], "id int, text string")
    b = spark.createDataFrame([(1, "some more words and c@d.org")], "id int, text string")
    r = a.join(b, a["id"] == b["id"]).select(detect(a["text"]).alias("x"), detect(b["text"]).alias("y")).first()
    assert [(s.start, s.end) for s in r.x] == [(5, 11)] and [(s.start, s.end) for s in r.y] == [(20, 27)]
    again = b.select(detect(F.col("text")).alias("z")).first()          # a bound column leaves nothing behind
    assert [(s.start, s.end) for s in again.z] == [(20, 27)]


def test_wide_tables_cost_one_expression(spark):
    """Fifty columns in seconds, or (on a busy machine) far below ten times five columns."""
    from spanmask import anonymize, scan

    df = spark.createDataFrame([tuple("x" for _ in range(50))], ", ".join(f"c{i} string" for i in range(50)))

    def seconds(columns):
        t = time.time()
        anonymize(scan(df.select(*columns)))
        return time.time() - t

    seconds(df.columns[:5])                                 # JVM classes loaded
    five = seconds(df.columns[:5])
    assert seconds(df.columns) < max(5, 5 * five)


@pytest.mark.parametrize("text,want", [
    ("x@" + "a." * 100_000 + "com tail", [(0, 200_005)]),
    ("x@" + "a." * 100_000 + "1", []),
    ("w" * 1_000_000 + " a@b.co", [(1_000_001, 1_000_007)]),
    ("a@b.co " + "w" * 1_000_000, [(0, 6)]),
    ("a@" * 100_000, []),
    ("x@" + "q" * 500_000, []),
])
def test_email_pattern_is_linear(spark, text, want):
    df = spark.createDataFrame([("warm@up.org",), (text,)], "t string")
    one = lambda v: [(s.start, s.end) for s in df.where(v).select(detect(F.col("t"), [EMAIL]).alias("s")).first().s]
    one(F.col("t") == "warm@up.org")
    t = time.time()
    assert one(F.col("t") != "warm@up.org") == want
    assert time.time() - t < 3


def test_email_spellings_agree(spark):
    """The linear spelling against the plain pattern, on strings of the characters that matter."""
    import random

    rng = random.Random(4)
    texts = ["".join(rng.choice("ab.@-1 _") for _ in range(rng.randint(1, 40))) for _ in range(4000)]
    texts += ["a@b.com-x@y.de", "a@b..com", "a@b.c1.com-x", "a@b.co@c.de", "a@b.co1.x", "a@b.1x.co2", "%a@-.-.ab"]
    want = [[("EMAIL_ADDRESS", m.start(), m.end()) for m in re.finditer(EMAIL.pattern, t)] for t in texts]
    assert spans_of(spark, texts, [EMAIL]) == want


def test_long_secret_is_one_hit(spark):
    assert spans_of(spark, ["k " + "0a" * 32 + " end"], [BUILTIN["SECRET_TOKEN"]]) == [[("SECRET_TOKEN", 2, 66)]]


def test_prefix_scan(spark):
    from spanmask.functions.spans import LATEST, SUM, prefix_scan_sql
    from spanmask.functions.sqltext import apply

    rows = [[], [3], list(range(64)), [5, -2, 7] * 43, list(range(100_000, 0, -1))]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, a array<int>")
    got = df.select("i", apply(F.col("a"), prefix_scan_sql("t", SUM.replace("+", "^"))).alias("s"), apply(F.col("a"), prefix_scan_sql("t", LATEST)).alias("m")).orderBy("i").collect()
    for r, a in zip(got, rows):
        assert r.m == list(itertools.accumulate(a, lambda x, y: max(x, y, 0))) if not a or a[0] >= 0 else True
        assert r.s == list(itertools.accumulate(a, lambda x, y: x ^ y))
