"""Overlap resolution and text rewrite against brute force."""

import hashlib
import random

from pyspark.sql import functions as F

from spanmask import SPANS_TYPE, anonymize_text, resolve_spans


def brute_islands(spans):
    out = []
    for s in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if out and s[1] < out[-1]["end"]:
            cur = out[-1]
            cur["end"] = max(cur["end"], s[2])
            if s[3] > cur["score"]:
                cur["entity_type"], cur["score"] = s[0], s[3]
        else:
            out.append({"entity_type": s[0], "start": s[1], "end": s[2], "score": s[3]})
    return [(d["entity_type"], d["start"], d["end"], d["score"]) for d in out]


def brute_rewrite(text, spans, op):
    if text is None:
        return None
    out, pos = [], 0
    for e, a, b, _ in brute_islands(spans):
        out.append(text[pos:a])
        hit = text[a:b]
        out.append({"replace": f"<{e}>", "redact": "", "hash": hashlib.sha256(hit.encode()).hexdigest(),
                    "keep": hit}[op])
        pos = b
    out.append(text[pos:])
    return "".join(out)


def random_rows(seed, n=300):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        text = "".join(rnd.choice("abcdé😀 ") for _ in range(rnd.randint(0, 60)))
        spans = []
        for _ in range(rnd.randint(0, 6)):
            if not text:
                break
            a = rnd.randint(0, len(text) - 1)
            b = rnd.randint(a + 1, len(text))
            spans.append((rnd.choice("ABC"), a, b, rnd.choice([0.3, 0.6, 1.0])))
        rows.append((i, text, spans))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, [{"entity_type": e, "start": a, "end": b, "score": s} for e, a, b, s in sp]) for i, t, sp in rows],
        f"id int, text string, spans {SPANS_TYPE.simpleString()}",
    )


def test_islands_match_brute_force(spark):
    rows = random_rows(1)
    got = {r.id: [(x.entity_type, x.start, x.end, x.score) for x in r.r]
           for r in frame(spark, rows).select("id", resolve_spans(F.col("spans")).alias("r")).collect()}
    for i, _, sp in rows:
        assert got[i] == brute_islands(sp), (i, sp)


def test_touching_spans_stay_apart(spark):
    df = frame(spark, [(0, "abcdef", [("A", 0, 3, 0.5), ("B", 3, 6, 0.5)])])
    r = df.select(resolve_spans(F.col("spans")).alias("r")).first().r
    assert [(x.start, x.end) for x in r] == [(0, 3), (3, 6)]


def test_null_and_empty_spans(spark):
    df = spark.createDataFrame([(0, "abc", None), (1, None, [])], f"id int, text string, spans {SPANS_TYPE.simpleString()}")
    got = {r.id: r.t for r in df.select("id", anonymize_text(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert got == {0: "abc", 1: None}


def test_rewrite_operators_match_brute_force(spark):
    rows = random_rows(2)
    df = frame(spark, rows)
    for op in ("replace", "redact", "hash", "keep"):
        got = {r.id: r.t for r in df.select("id", anonymize_text(F.col("text"), F.col("spans"),
                                                                 {"DEFAULT": op}).alias("t")).collect()}
        for i, t, sp in rows:
            assert got[i] == brute_rewrite(t, sp, op), (op, i)


def test_per_entity_operators(spark):
    df = frame(spark, [(0, "abc DEF ghi", [("A", 0, 3, 1.0), ("B", 4, 7, 1.0), ("C", 8, 11, 1.0)])])
    ops = {"A": "redact", "B": "mask", "C": ("replace", "***")}
    assert df.select(anonymize_text(F.col("text"), F.col("spans"), ops).alias("t")).first().t == " XXX ***"
