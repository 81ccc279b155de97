"""Row keys for strategies that take a table apart and join it again."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.config import ensure_checkpoint_dir
from .columns import q

ROW_KEY = "_row_key"


def batch_only(df: DataFrame, what: str):
    if df.isStreaming:
        raise ValueError(f"{what} needs a row id and a join, which Spark does not allow on a stream")


def keyed_rows(df: DataFrame, key: Optional[str]) -> DataFrame:
    """``df`` with a unique row key that both sides of a self-join agree on.

    A caller's unique, non-null ``key`` is used as it is.  Without one the rows get a
    ``monotonically_increasing_id``; it depends on partition layout and row
    order, which is not kept between two evaluations (nor across a task retry), so the
    rows are then written once with ``checkpoint()`` to the shared ``spark.checkpoint.dir``.
    """
    if key is not None:
        return df.withColumn(ROW_KEY, q(key))
    ensure_checkpoint_dir(df.sparkSession)
    return df.withColumn(ROW_KEY, F.monotonically_increasing_id()).checkpoint(eager=True)
