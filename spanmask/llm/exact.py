"""Exact duplicates by a sort of the contents, with DataFrame functions only.

Rows are dealt to tasks by ranges of their (normalised) text.  The splitters are sampled from the first
characters and a 64-bit hash of the text, so that a sampled key has a bounded size however long texts
are.  Each task sorts its range externally by the whole text; equal texts are then neighbours, and a window over
whole texts compares each row with the one before it.

A text with many copies would fill one range.  Copies are counted first (hashes only, combined
before the shuffle), and a text with more than its share of the rows gets a number of pieces: a third key, after the
hash, spreads its copies over that many neighbouring ranges.  One row of each piece carries the text, and the pieces of
a text are joined again by whole text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

#: First characters of a text in the key that splitters are sampled from.
HEAD = 32
#: A text is cut into pieces once its copies pass this part of a task's even share of the rows.
SHARE = 4


def _pieces(rows: DataFrame) -> DataFrame:
    """(code, pieces) of the texts with many copies: fewer than SHARE x shuffle partitions rows, whatever the input."""
    spark = rows.sparkSession
    shares = SHARE * int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = rows.count()
    counts = rows.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    pieces = F.ceil(F.col("n") * F.lit(shares) / F.lit(max(total, 1))).cast("long")
    return written(counts.where(F.col("n") * F.lit(shares) > F.lit(total)).select("code", pieces.alias("pieces")), "many_copies")


def exact_duplicates(
    docs: DataFrame, *, normalise: Callable[[Column], Column] | None = None, keep: str = "largest"
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when ``normalise`` makes them identical (default: no change; a null text is an empty one).
    Of equal texts one row stays, the one with the ``largest`` or ``smallest`` doc_id; of several rows with that
    doc_id one stays.  Rows without a doc_id stay only where no row of the group has one, and keep_id is then
    null.  ``group_size`` counts all rows, and text_sha256 is that of the normalised text in UTF-8.  An empty table gives
    an empty result; other columns are ignored.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep must be 'largest' or 'smallest'")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (normalise(text) if normalise else text).alias("text"))
    rows = rows.withColumn("code", F.xxhash64("text"))
    many = _pieces(rows.select("code"))
    salt = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("pieces")), F.lit(0))
    dealt = rows.join(F.broadcast(many), "code", "left").withColumns({"salt": salt, "head": F.substring("text", 1, HEAD)})
    ranged = dealt.repartitionByRange("head", "code", "salt")
    first = F.col("doc_id").desc_nulls_last() if keep == "largest" else F.col("doc_id").asc_nulls_last()
    equal = Window.partitionBy("head", "code", "salt", "text").orderBy(first)
    whole = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranged = ranged.withColumns({
        "place": F.row_number().over(equal), "best": F.first("doc_id").over(whole), "size": F.count(F.lit(1)).over(whole),
    })
    runs = written(ranged.select(
        "doc_id", "salt", "place", "best", "size", F.sha2("text", 256).alias("text_sha256"),
        F.when(F.col("pieces").isNotNull() & (F.col("place") == 1), F.col("text")).alias("piece_text"),
    ), "equal_runs")

    # Fewer rows than texts with many copies: the bound of _pieces.
    best, salt = F.col("best").alias("best"), F.col("salt")
    if keep == "largest":
        chosen = F.max(F.struct(best.isNotNull().alias("known"), best, (-salt).alias("salt")))
    else:
        chosen = F.min(F.struct(best.isNull().alias("unknown"), best, salt.alias("salt")))
    joined = runs.where(F.col("piece_text").isNotNull()).groupBy("text_sha256", "piece_text").agg(F.sum("size").alias("all_rows"), chosen.alias("chosen"))
    joined = joined.select("text_sha256", "all_rows", F.col("chosen.best").alias("all_best"), F.abs("chosen.salt").alias("all_salt"))
    out = runs.join(F.broadcast(joined), "text_sha256", "left")
    several = F.col("all_rows").isNotNull()
    return out.select(
        "doc_id",
        F.when(several, F.col("all_best")).otherwise(F.col("best")).alias("keep_id"),
        F.coalesce("all_rows", "size").cast("long").alias("group_size"),
        ((F.col("place") == 1) & (F.col("salt") == F.coalesce("all_salt", "salt"))).alias("kept"),
        "text_sha256",
    )
