"""Distinct values per (column, entity type): k-minimum-values sketches as tables.

A sketch is the ``k`` smallest distinct 64-bit hashes of the values found.  Below k hashes it holds
all of them and the count is exact; from k on the k-th smallest hash says how densely the hashes lie, with a relative error of about
1/sqrt(k - 2).  Sketches of parts of a table add up: their union, cut to k again, is the sketch of the whole, so
micro-batches store theirs like the other parts of the summary.

Hashes are made distinct by a grouping that spreads over all tasks by hash, and each task keeps its k smallest per (column, entity
type) before the final cut (Spark pushes the rank limit below the shuffle), so a column with most of
the hits is not gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .columns import RESULT_COL, q, result_columns, spans_col

#: Hashes per sketch; not more than ``spark.sql.optimizer.windowGroupLimitThreshold`` (1,000), up to which tasks cut before the shuffle.
K = 1000


def _smallest(hashes: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("column", "entity_type").orderBy("hash"))
    distinct = hashes.select("column", "entity_type", "hash").distinct()
    return distinct.withColumn("place", place).where(F.col("place") <= k).drop("place")


def distinct_parts(scanned: DataFrame, k: int = K, result_col: str = RESULT_COL) -> DataFrame:
    """(column, entity_type, hash): the sketches of a scanned table.

    A value is the text of a span as found, cell by cell; null and empty cells have none.
    """
    analysed, _ = result_columns(scanned, result_col)
    if not analysed:
        raise ValueError("no analysed columns in the scan result")
    span = lambda c: F.transform(
        F.coalesce(spans_col(scanned, c, result_col), F.array()),
        lambda s: F.struct(
            F.lit(c).alias("column"), s["entity_type"].alias("entity_type"),
            F.xxhash64(F.substring(q(c).cast("string"), s["start"] + 1, s["end"] - s["start"])).alias("hash")),
    )
    found = scanned.select(F.inline(F.flatten(F.array(*[F.array_distinct(span(c)) for c in analysed]))))
    return _smallest(found, k)


def merge_distinct(parts: DataFrame, k: int = K) -> DataFrame:
    """``column, entity_type, distinct_values, exact`` from any number of sketches of the same ``k``."""
    sizes = _smallest(parts, k).groupBy("column", "entity_type").agg(F.count(F.lit(1)).alias("n"), F.max("hash").alias("last"))
    # Hashes are signed: the k-th smallest lies at this part of their range.
    part = (F.col("last").cast("double") + F.lit(float(1 << 63))) / F.lit(float(1 << 64))
    full = F.col("n") >= k
    estimate = F.round((F.lit(k) - 1) / part).cast("long")
    return sizes.select("column", "entity_type", F.when(full, estimate).otherwise(F.col("n")).alias("distinct_values"), (~full).alias("exact"))


def distinct_values(scanned: DataFrame, k: int = K, result_col: str = RESULT_COL) -> DataFrame:
    """``column, entity_type, distinct_values, exact``: how many different values of each type a column holds."""
    return merge_distinct(distinct_parts(scanned, k, result_col), k)
