import math
import time
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from spanmask.llm.url_rules import RULES, judge, mine, tokens

from . import brute

URLS = [
    "http://a.example.org/es/1", "http://example.org/es/", "http://EXAMPLE.org/en/12?x=1", "https://b.com/fr/x", "https://b.com/de/y#z",
    "https://b.com/de", "http://org/", "http://org", "http://forg/x", "ftp://x.org?a://b", "no scheme", None, "", "://", "http://É.com/de/", "http://a.com#/de/", "x\n://y.com/de/\n?z",
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS)], "page_id long, url string, host int")
    nothing = spark.createDataFrame([], "url string, blocked boolean")
    for r in judge(pages, nothing).collect():
        url = URLS[r.page_id]
        rule, verdict = brute.url_rule(url, RULES)
        assert (r.host, r.path) == brute.url_parts(url), url
        assert (r.rule, r.verdict) == (rule, verdict or "allow"), url
    assert judge(pages.limit(0), nothing).collect() == []


def wilson_low(b, n, z=1.96):
    p = b / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def enumerated(spark, rows):
    """(page_ids that some combination of tokens blocks, the sure combinations) by enumeration."""
    df = spark.createDataFrame(rows, "page_id long, url string, blocked boolean")
    baskets = [(set(r.t), r.blocked) for r in df.select(tokens(F.col("url")).alias("t"), "blocked").collect()]
    counts = {}
    for basket, bad in baskets:
        for k in range(1, len(basket) + 1):
            for c in combinations(sorted(basket), k):
                n, b = counts.get(c, (0, 0))
                counts[c] = (n + 1, b + bad)
    sure = {c for c, (n, b) in counts.items() if b >= 0.002 * len(rows) and b >= 0.85 * n and wilson_low(b, n) >= 0.6}
    return df, {i for (i, _, _), (basket, _) in zip(rows, baskets) if any(set(c) <= basket for c in sure)}, sure


def test_mined_rules(spark):
    """All sure rules by enumeration."""
    rows = []
    for i in range(300):
        bad = i % 5 == 0
        rows.append((i, f"http://{'win' if i % 10 == 0 else 'h' + str(i % 7)}.casino{i % 3}.net/{'spin' if bad else 'read'}/{i}?{'aff=1' if i % 15 == 0 else 'q=2'}", bad or i % 97 == 0))
    df, want, _ = enumerated(spark, rows)
    got = judge(df.select("page_id", "url"), df.select("url", "blocked")).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == want and want
    assert len(got) == 300


def test_combinations_only(spark):
    """No token alone is sure: x with y is blocked, either alone is not.  Mined rules decide beside given ones."""
    rows = []
    for i in range(240):
        x, y = i % 4 in (0, 1), i % 4 in (0, 2)
        site = "shop.com/de" if i % 12 == 0 else "other.org/a" if i % 12 == 1 else "third.net/b"
        rows.append((i, f"https://{site}/{'x' if x else 'u'}/{'y' if y else 'v'}", x and y or i % 40 == 3))
    df, want, sure = enumerated(spark, rows)
    assert all(len(c) > 1 for c in sure if "path:y" in c)
    got = {r.page_id: r for r in judge(df.select("page_id", "url"), df.select("url", "blocked")).collect()}
    fits = {i: brute.url_rule(u, RULES) for i, u, _ in rows}
    for i, r in got.items():
        assert r.verdict == (fits[i][1] or ("block" if i in want else "allow")) and (r.mined_rule is not None) == (i in want)
    decided = [i for i in want if fits[i][1] is None]
    assert len(decided) > 20 and any(fits[i][1] for i in got)
    (rule,) = {got[i].mined_rule for i in decided}
    assert {"path:x", "path:y"} <= set(rule.split())


@pytest.mark.parametrize("keys", [6, 15, 40])
def test_shared_query_keys_do_not_multiply(spark, keys):
    query = "&".join(f"k{chr(97 + j // 26)}{chr(97 + j % 26)}=1" for j in range(keys))
    rows = [(i, f"https://shop.net/p?{query}{'&bad=1&worse=2' if i % 6 == 0 else ''}{'&odd=1' if i % 7 == 0 else ''}", i % 6 == 0) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, blocked boolean")
    began = time.time()
    rules = mine(df.select("url", "blocked")).collect()
    got = judge(df.select("page_id", "url"), df.select("url", "blocked")).collect()
    assert time.time() - began < 60
    assert [(r.antecedent, r.confidence, r.pages) for r in rules] == [(["query:bad", "query:worse"], 1.0, 50)]
    assert {r.page_id for r in got if r.verdict == "block"} == set(range(0, 300, 6))
    if keys == 6:
        assert enumerated(spark, rows)[1] == set(range(0, 300, 6))


def test_few_pages_prove_nothing(spark):
    rows = [(i, f"http://site{'x' if i < 5 else 'y'}.net/{i}", i < 5) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, blocked boolean")
    assert mine(df).collect() == []
    assert mine(df.withColumn("blocked", F.lit(False))).collect() == [] and mine(df.limit(0)).collect() == []


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string").withColumns({c: F.lit("z") for c in ("host", "path", "rule", "verdict", "mined_rule", "token", "row")})
    labelled = spark.createDataFrame([("http://a.net/x", True)] * 9, "url string, blocked boolean").withColumns({c: F.lit("z") for c in ("row", "tokens", "items", "n", "bad")})
    (r,) = judge(pages, labelled).collect()
    assert (r.host, r.path, r.rule, r.verdict) == ("a.net", "/x", None, "block")     # all labelled URLs are blocked


def test_repeated_and_null_ids(spark):
    pages = spark.createDataFrame([(1, "http://a.com/de/"), (1, "http://a.com/de/"), (None, "http://a.org/")], "page_id long, url string")
    labelled = spark.createDataFrame([(None, True), ("http://a.org/", None)], "url string, blocked boolean")
    assert sorted(r.verdict for r in judge(pages, labelled).collect()) == ["allow", "block", "block"]
