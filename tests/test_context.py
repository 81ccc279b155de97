"""Scores from context words: against a plain reading of the definition, and the edges."""

import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from spanmask import anonymize, scan
from spanmask.functions.context import CONTEXTS, Context, rescore
from spanmask.functions.recognizers import CREDIT_CARD, PHONE, Recognizer
from spanmask.functions.spans import SPANS_TYPE, detect

RUN = Recognizer("RUN", "[0-9x]{3,}", 0.5)
SHORT = Recognizer("SHORT", "[0-9]{2,}", 0.3)
RULES = {"RUN": Context(("card", "é"), ("no",), 0.4, 0.25, window=2), "SHORT": Context((), ("x", "card"), window=1)}


def plain(text, spans, rules):
    words = [(m.start(), m.end(), m.group().lower()) for m in regex.finditer(r"\p{L}+", text)]
    out = []
    for s in spans:
        score, rule = s.score, rules.get(s.entity_type)
        if rule:
            near = [w for b, e, w in words if e <= s.start][-rule.window:] + [w for b, e, w in words if b >= s.end][:rule.window]
            score += rule.raise_by * any(w in rule.raises for w in near) - rule.lower_by * any(w in rule.lowers for w in near)
            score = round(max(0.0, min(1.0, score)), 6)
        out.append((s.entity_type, s.start, s.end, score))
    return out


def test_against_the_definition(spark):
    rng = random.Random(5)
    bits = ["card", "Card", "no", "É", "x", "12", "3456", "9x9x", " ", " ", ", ", "-", "𝒳", "\n", "word", "card77", "77no"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("s", detect(F.col("t"), [RUN, SHORT]))
    for r in df.select("t", "s", rescore(F.col("t"), F.col("s"), RULES).alias("r")).collect():
        assert [tuple(x) for x in r.r] == plain(r.t, r.s, RULES), r.t


@pytest.mark.parametrize("text,score", [
    ("call +1 (555) 123-4567", 1.0), ("+1 (555) 123-4567 mobile", 1.0), ("the fax: +1 (555) 123-4567", 0.4), ("CALL or fax +1 (555) 123-4567", 0.75),
    ("call a b c d e +1 (555) 123-4567", 0.75), ("call b c d e +1 (555) 123-4567", 1.0), ("recall +1 (555) 123-4567", 0.75), ("+1 (555) 123-4567", 0.75)])
def test_band_and_limits(spark, text, score):
    df = spark.createDataFrame([(text,)], "t string")
    ((spans,),) = df.select(rescore(F.col("t"), detect(F.col("t"), [PHONE]))).collect()
    assert [s.score for s in spans] == [score]


def test_edges(spark):
    df = spark.createDataFrame([(None, None), ("", []), ("call 12", None), (None, [("PHONE_NUMBER", 0, 3, 0.5)])], spark.createDataFrame([], "t string").schema.add("s", SPANS_TYPE))
    got = [r[0] for r in df.select(rescore(F.col("t"), F.col("s"))).collect()]
    assert got[:3] == [[], [], []] and [tuple(x) for x in got[3]] == [("PHONE_NUMBER", 0, 3, 0.5)]
    for bad in ({"raises": ("two words",)}, {"raises": ("Card",)}, {"lowers": ("",)}, {"window": 0}, {"raise_by": -1.0}):
        with pytest.raises(ValueError):
            Context(**bad)
    assert all(isinstance(c, Context) for c in CONTEXTS.values())


def test_labels_of_overlaps_follow_the_scores(spark):
    run = Recognizer("ACCOUNT", "[0-9]{6,}", 0.5)
    rules = {"ACCOUNT": Context(("account",), raise_by=0.5), "CREDIT_CARD": Context((), ("account",), lower_by=0.4)}
    df = spark.createDataFrame([("account 4111111111111111.",), ("pay 4111111111111111.",), ("account 123456",), ("number 123456",)], "t string")
    for strategy, key in (("columns", None), ("stacked", "k")):
        s = scan(df.withColumn("k", F.monotonically_increasing_id()), exclude=["k"], recognizers=[CREDIT_CARD, run], context=rules, min_score=0.55, strategy=strategy, key=key)
        assert sorted(r.t for r in anonymize(s).collect()) == ["account <ACCOUNT>", "account <ACCOUNT>.", "number 123456", "pay <CREDIT_CARD>."]


def test_min_score_alone(spark):
    df = spark.createDataFrame([("10.0.0.1 and 4111111111111111",)], "t string")
    (r,) = anonymize(scan(df, min_score=0.9)).collect()
    assert r.t == "10.0.0.1 and <CREDIT_CARD>"


def test_wide_table_and_long_cell(spark):
    long = " ".join(["word"] * 60_000 + ["call", "+1 (555) 123-4567"] + ["word"] * 60_000)
    df = spark.createDataFrame([(long,)], "t string").select("t", *[F.lit("fax +1 (555) 123-4567").alias(f"c{i}") for i in range(20)])
    (r,) = scan(df, context=CONTEXTS).collect()
    found = r.pii_analysis_result.analysis_results
    assert found.t[0].score == 1.0 and all(found[f"c{i}"][0].score == 0.4 for i in range(20))
    assert re.search(r"\+1", long).start() == found.t[0].start
