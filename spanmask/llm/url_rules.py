"""URL filter: given host and path rules, and association rules mined from labels.

Everything is DataFrame functions and Spark's FP-growth.  A URL's tokens are its scheme,
host labels, path words, ending, query keys and fragment.  Rules say that some tokens go with a blocked label, so the label
is fixed as the consequent: FP-growth mines the combinations that are frequent among blocked URLs only, and a second pass counts them in
the others.  Before mining, tokens that stand in the same URLs are folded into one, and those
that stand in all of them go, since a combination says no more with them; a token that is a sure rule alone goes too.  So templates of
many shared query keys make one item, not all subsets of them.

Rules are pruned by support and confidence (a share, and the lower Wilson bound of it, so that few pages prove
nothing), and a rule that contains a sure one goes.  Matching uses an inverted index: a rule is
filed under its rarest token, a URL looks up its tokens and checks the rules found.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

#: (verdict, host, path): fits the host and its subdomains if the path starts so; the longest wins.
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
#: Share of the labelled URLs that a rule blocks at least, share of blocked among those it fits, and the least lower bound
#: (Z: two-sided 95 %) of the latter; six pages without an exception reach it.  The same at all sizes of the table.
SUPPORT, CONFIDENCE, PROVEN, Z = 0.002, 0.85, 0.6, 1.96
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), UPPER, LOWERED)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def given_rule(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of a configured list of rules that fits; else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == h) | F.endswith(host_, F.lit("." + h))) & F.startswith(path_, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens, each with the part of the URL it stands in; numbers are ``#``."""
    def part(mark: str, text: Column, split: str) -> Column:
        words = F.split(F.regexp_replace(F.lower(text), "[0-9]+", "#"), split)
        return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(mark), w))

    rest = _rest(url)
    return F.array_distinct(F.concat(
        part("scheme:", F.substring_index(F.coalesce(url, F.lit("")), "://", 1), "$"),
        part("host:", host(url), "[.]"), part("site:", F.substring_index(host(url), ".", -3), "$"),
        part("path:", path(url), "[/._-]"),
        part("query:", F.regexp_extract(rest, "[?]([^#]*)", 1), "=[^&]*&?|&"),
        part("frag:", F.regexp_extract(rest, "#(.*)$", 1), "$"),
    ))


def _wilson_low(hits: Column, n: Column) -> Column:
    p, zz = hits / n, F.lit(Z * Z) / n
    return (p + zz / 2 - Z * F.sqrt(p * (1 - p) / n + zz / (4 * n))) / (1 + zz)


def _sure(bad: Column, n: Column, confidence: float) -> Column:
    return (bad >= F.lit(confidence) * n) & (_wilson_low(bad, n) >= PROVEN)


def _folded(rows: DataFrame, total: int, support: float, confidence: float) -> tuple[DataFrame, DataFrame]:
    """(item, members, bad, n, sure): the tokens that stand in the same URLs as one item, the first by name; and (row, token) of all.

    Two 64-bit sums of row hashes and the count tell sets of rows apart.
    """
    pairs = written(rows.select("row", "blocked", F.explode("tokens").alias("token")), "url_tokens")
    sets = pairs.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("blocked").alias("bad"),
        F.expr("bit_xor(xxhash64(row))").alias("a"), F.expr("bit_xor(xxhash64(row, 1))").alias("b"))
    items = sets.groupBy("a", "b", "n", "bad").agg(F.min("token").alias("item"), F.array_sort(F.collect_list("token")).alias("members"))
    items = items.where(F.col("bad") >= F.lit(support) * total).select("item", "members", "bad", "n", _sure(F.col("bad"), F.col("n"), confidence).alias("sure"))
    return written(items, "url_items"), pairs


def mine(labelled: DataFrame, *, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(antecedent, confidence, pages, anchor) rules for blocking, from rows (url, blocked).

    ``pages`` is the number of labelled URLs that the rule fits.  Antecedents are spelled with the tokens of all their items.
    """
    spark = labelled.sparkSession
    rows = labelled.where("url is not null and blocked is not null").select(
        F.monotonically_increasing_id().alias("row"), F.col("blocked").cast("boolean").alias("blocked"), tokens(F.col("url")).alias("tokens"))
    rows = written(rows, "baskets")
    total = rows.count()
    if total == 0:
        return spark.createDataFrame([], "antecedent array<string>, confidence double, pages long, anchor string")
    items, pairs = _folded(rows, total, support, confidence)
    single = items.where("sure").select(F.array("item").alias("items"), "bad", "n")
    open_ = items.where(F.lit(total) > F.col("n")).where("not sure").select(F.col("item").alias("token"), "n")
    baskets = written(pairs.join(open_.select("token"), "token").groupBy("row", "blocked").agg(F.collect_list("token").alias("items")), "items")
    blocked = baskets.where("blocked")
    share = support * total / max(1, blocked.count())
    found = single
    if share <= 1 and not blocked.isEmpty():
        model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=1.0).fit(blocked.select("items"))
        sets = model.freqItemsets.where(F.size("items") > 1).select(F.array_sort("items").alias("items"), F.col("freq").alias("bad"))
        # How often each combination stands in URLs that are not blocked: looked up by its rarest item.
        rare = sets.withColumn("token", F.explode("items")).join(open_, "token").groupBy("items", "bad").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
        rare = written(rare, "combinations")
        clean = baskets.where("not blocked").select("items").withColumn("token", F.explode("items")).withColumnRenamed("items", "basket")
        others = clean.join(rare, "token").where(F.size(F.array_except("items", "basket")) == 0).groupBy("items").agg(F.count(F.lit(1)).alias("clean"))
        counted = rare.join(others, "items", "left").select("items", "bad", (F.col("bad") + F.coalesce("clean", F.lit(0))).alias("n"))
        found = single.unionByName(counted.where(_sure(F.col("bad"), F.col("n"), confidence)))
    found = written(found.select("items", (F.col("bad") / F.col("n")).alias("confidence"), F.col("n").alias("pages")), "rules")
    count = items.select(F.col("item").alias("token"), "n")
    anchor = found.withColumn("token", F.explode("items")).join(count, "token").groupBy("items", "confidence", "pages").agg(F.min_by("token", F.struct("n", "token")).alias("anchor"))
    anchor = written(anchor, "anchors")
    # A rule that contains a sure one fits nothing more; the shorter is looked up by its rarest item.
    fewer = anchor.select(F.col("items").alias("fewer"), F.col("anchor").alias("token"))
    weak = (
        anchor.select("items", F.explode("items").alias("token")).join(fewer, "token")
        .where((F.size("fewer") < F.size("items")) & (F.size(F.array_except("fewer", "items")) == 0)).select("items").distinct()
    )
    kept = anchor.join(weak, "items", "left_anti")
    spelled = kept.withColumn("item", F.explode("items")).join(items.select("item", "members"), "item").groupBy("items", "confidence", "pages", "anchor").agg(
        F.array_sort(F.flatten(F.collect_list("members"))).alias("antecedent"))
    return written(spelled.select("antecedent", "confidence", "pages", "anchor"), "mined")


def blocked_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined_rule, confidence) for each distinct URL that a mined rule fits; the surest, then the first by tokens."""
    index = rules.groupBy(F.col("anchor").alias("token")).agg(F.collect_list(F.struct("confidence", "antecedent")).alias("filed"))
    looked = (
        urls.where("url is not null").select("url").distinct().withColumn("tokens", tokens(F.col("url")))
        .withColumn("token", F.explode("tokens")).join(index, "token")
        .withColumn("fits", F.filter("filed", lambda r: F.size(F.array_except(r["antecedent"], F.col("tokens"))) == 0)).where(F.size("fits") > 0)
    )
    best = F.struct((-F.col("confidence")).alias("c"), F.array_join("antecedent", " ").alias("r"))
    return (
        looked.select("url", F.inline("fits")).groupBy("url").agg(F.min(best).alias("b"))
        .select("url", F.col("b.r").alias("mined_rule"), (-F.col("b.c")).alias("confidence"))
    )


def judge(pages: DataFrame, labelled: DataFrame, *, rules=RULES, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Per row of ``pages`` (page_id, url): host, path, rule, verdict, mined_rule.

    ``labelled`` has rows (url, blocked).  A given rule decides; else a URL that a mined rule fits is
    blocked, any other allowed.  Null URLs and those without ``://`` have an empty host and path, no
    rule and are allowed unless mined otherwise.  Null and repeated page_ids pass; other columns are ignored.
    """
    mined = mine(labelled, support=support, confidence=confidence)
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"))
    found = blocked_urls(pages, mined).select("url", "mined_rule")
    h, p = host(F.col("url")), path(F.col("url"))
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    return (
        pages.withColumn("host", h).withColumn("path", p).join(found, "url", "left")
        .select(
            "page_id", "host", "path", rule.alias("rule"),
            F.coalesce(verdict, F.when(F.col("mined_rule").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "mined_rule",
        )
    )


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, blocked): pages whose page_id is a labelled doc_id; blocked if toxic or of low quality."""
    bad = labels.select("doc_id", "toxic", "quality")
    return pages.select("page_id", "url").join(bad, F.col("page_id") == F.col("doc_id")).select("url", ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("blocked"))
