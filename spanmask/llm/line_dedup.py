"""Site-relative boilerplate lines, with DataFrame functions only.

A line's share is the number of a host's pages that contain it over the number of the
host's pages.  Lines above the share go, from every page of the host.  With ``fold`` pages with equal text are one page, so
that copies of a page do not make its own lines boilerplate.  A page has few
lines that others share, so a host cannot have more than (distinct lines per page) / share such
lines: they fit in one array per host, and pages meet them in one join on the host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import fresh, written

#: Above this share of its host's pages a line is boilerplate: one page in twenty.  A template puts its lines on all pages
#: of a section, and a section of interest has that many pages; a phrase that authors repeat does not reach it ...
RATIO = 0.05
#: ... if that many pages have it: on a host of few pages a line that two of them share is a quotation, not a template.
#: A parameter of both functions, the same at all sizes of the table.
MIN_PAGES = 5


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(docs: DataFrame, host: str = "source", *, ratio: float = RATIO, min_pages: int = MIN_PAGES, fold: bool = False) -> DataFrame:
    """(host, lines): the 64-bit keys of each host's boilerplate lines."""
    text = F.col("text").cast("string")
    lines = F.array_distinct(F.transform(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != ""), _key))
    pages = docs.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.xxhash64(text).alias("page"), lines.alias("lines"))
    if fold:
        pages = pages.groupBy("host", "page").agg(F.first("lines").alias("lines"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = pages.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    often = counts.where(F.col("n") >= min_pages).join(totals, "host").where(F.col("n") > F.lit(ratio) * F.col("pages"))
    return often.groupBy("host").agg(F.collect_set("line").alias("lines"))


def drop_boilerplate(
    docs: DataFrame, host: str = "source", *, ratio: float = RATIO, min_pages: int = MIN_PAGES, counts: bool = True, fold: bool = False
) -> DataFrame:
    """All columns of ``docs`` with ``text`` cut, and with ``counts`` n_lines (not blank) and n_dropped.

    Lines are parted by \\n and compared without spaces around them; blank lines stay.  Null
    texts stay null and have no line; a null host is one host with the empty one.  Null and
    repeated doc_ids pass: rows are judged one by one.  With ``counts`` the new columns must not
    have the name of one of ``docs``: that is an error.
    """
    clash = {c.lower() for c in docs.columns} & {"n_lines", "n_dropped"}
    if counts and clash:
        raise ValueError(f"columns {sorted(clash)} are in the table; rename them, or use counts=False")
    key, drops = fresh("_host", docs), fresh("_lines", docs)
    found = written(boilerplate(docs, host, ratio=ratio, min_pages=min_pages, fold=fold), "boilerplate").toDF(key, drops)
    joined = docs.withColumn(key, F.coalesce(F.col(host).cast("string"), F.lit(""))).join(found, key, "left")
    lines = F.split(F.col("text").cast("string"), "\n")
    bad = lambda x: (F.trim(x) != "") & F.coalesce(F.array_contains(F.col(drops), _key(x)), F.lit(False))
    kept = F.when(F.col(drops).isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, lambda x: ~bad(x)), "\n"))
    if not counts:
        return joined.withColumn("text", kept).select(*docs.columns)
    count = lambda rule: F.coalesce(F.size(F.filter(lines, rule)).cast("long"), F.lit(0).cast("long"))
    n = F.when(F.col("text").isNull(), F.lit(0).cast("long"))
    return joined.withColumns({
        "n_lines": n.otherwise(count(lambda x: F.trim(x) != "")), "n_dropped": n.when(F.col(drops).isNull(), F.lit(0).cast("long")).otherwise(count(bad)), "text": kept,
    }).select(*docs.columns, "n_lines", "n_dropped")
