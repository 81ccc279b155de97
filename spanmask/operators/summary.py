"""Scan summary per (column, entity type)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import RESULT_COL, result_columns, spans_col

SUMMARY_TYPE = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("num_entities", T.DoubleType()),
        T.StructField("avg_score", T.DoubleType()),
        T.StructField("sample_size", T.LongType()),
        T.StructField("hit_rate", T.DoubleType()),
    ]
)


def summary_parts(scanned: DataFrame, result_col: str = RESULT_COL) -> DataFrame:
    """``column, entity_type, n, score_sum, rows``: sums that add up over any parts of a table.

    Each (row, column) emits one small record per entity type it holds,
    plus one marker record (null type) that only counts the row; a single grouping on
    (column, entity_type) then yields everything.  The key space is tiny
    and the aggregate is partial, so a hot column is combined map-side.
    """
    analysed, _ = result_columns(scanned, result_col)
    if not analysed:
        raise ValueError("no analysed columns in the scan result")
    stat = T.StructType(
        [
            T.StructField("entity_type", T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("score_sum", T.DoubleType()),
        ]
    )

    def per_cell(c):
        spans = F.coalesce(spans_col(scanned, c, result_col), F.array())
        kinds = F.array_distinct(F.transform(spans, lambda s: s["entity_type"]))
        per_kind = F.transform(
            kinds,
            lambda e: F.struct(
                e.alias("entity_type"),
                F.size(F.filter(spans, lambda s: s["entity_type"] == e)).cast("long").alias("n"),
                F.aggregate(F.filter(spans, lambda s: s["entity_type"] == e), F.lit(0.0),
                            lambda a, s: a + s["score"]).alias("score_sum"),
            ),
        )
        marker = F.array(F.struct(F.lit(None).cast("string").alias("entity_type"),
                                  F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("score_sum")))
        return F.struct(F.lit(c).alias("column"), F.concat(per_kind.cast(T.ArrayType(stat)), marker).alias("stats"))

    cells = scanned.select(F.explode(F.array(*[per_cell(c) for c in analysed])).alias("cell"))
    recs = cells.select(F.col("cell.column").alias("column"), F.inline("cell.stats"))
    return recs.groupBy("column", "entity_type").agg(
        F.sum("n").alias("n"), F.sum("score_sum").alias("score_sum"), F.count(F.lit(1)).alias("rows")
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """The summary of all rows behind any number of ``summary_parts``."""
    agg = parts.groupBy("column", "entity_type").agg(
        F.sum("n").alias("n"), F.sum("score_sum").alias("score_sum"), F.sum("rows").alias("rows")
    )
    w = Window.partitionBy("column")
    total = F.max(F.when(F.col("entity_type").isNull(), F.col("rows"))).over(w)
    return (
        agg.withColumn("sample_size", total)
        .where(F.col("entity_type").isNotNull())
        .select(
            "column",
            "entity_type",
            F.col("n").cast("double").alias("num_entities"),
            (F.col("score_sum") / F.col("n")).alias("avg_score"),
            F.col("sample_size").cast("long").alias("sample_size"),
            (F.col("rows") / F.col("sample_size")).cast("double").alias("hit_rate"),
        )
    )


def summarize(scanned: DataFrame, result_col: str = RESULT_COL) -> DataFrame:
    """``column, entity_type, num_entities, avg_score, sample_size, hit_rate``.

    * num_entities -- spans of that type in that column
    * avg_score -- their mean score
    * sample_size -- rows scanned
    * hit_rate -- rows with at least one such span / sample_size
    """
    return merge_parts(summary_parts(scanned, result_col))
