"""Partition sizing."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame


def balance_splits(df: DataFrame, min_partitions: Optional[int] = None) -> DataFrame:
    """Spread a *bare file read* over enough tasks for a CPU-heavy stage.

    A parquet file written as one row group reads as one split, so every
    text expression above it would run in one task.  When the read has
    fewer splits than ``min_partitions`` (default: twice the cores) it is
    round-robin repartitioned once, before any heavy work.

    For small inputs on few cores, such as a benchmark; it is called by hand and by
    no query.  Only call it on a plain ``spark.read`` result: counting the splits of
    a plan with an exchange would run that exchange.
    """
    if df.isStreaming:
        return df
    want = min_partitions or max(1, df.sparkSession.sparkContext.defaultParallelism * 2)
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
