"""Places of rows in ordered groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import written


def run_starts(column: pa.Array, last) -> np.ndarray:
    """Where a value differs from the one before it; ``last`` is the value before the first (None: there is none)."""
    n = len(column)
    new = np.ones(n, dtype=bool)
    if n > 1:
        new[1:] = pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    if n and last is not None:
        new[0] = column[0].as_py() != last
    return new


def _within(group: str):
    """Adds (part, place): the number of the task and the row's place among the task's rows of its group."""

    def run(batches):
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column, at = batch.column(batch.schema.get_field_index(group)), np.arange(n)
            start = np.maximum.accumulate(np.where(run_starts(column, last), at, -1))
            place = np.where(start >= 0, at - start, seen + at)
            last, seen = column[n - 1].as_py(), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part)), pa.array(place)], names=[*batch.schema.names, "part", "place"])

    return run


def placed(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``at``: the place, from 0, of each row in its ``group`` (a string, not null) in ascending ``order``, nulls first.

    Rows are dealt by ranges of (group, order) and sorted in their tasks, so a group of any size spreads over many tasks;
    rows that are alike in all of these spread too.  A task continues at most one group of earlier
    tasks, so the offsets that are broadcast are fewer than the tasks.  The result is written.
    """
    keys = [group, *order, "_deal"]
    dealt = rows.withColumn("_deal", F.rand(7)).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_deal")
    schema = T.StructType([*dealt.schema.fields, T.StructField("part", T.LongType()), T.StructField("place", T.LongType())])
    within = written(dealt.mapInArrow(_within(group), schema), name)
    counts = within.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.withColumn("before", before).where("before > 0").select(group, "part", "before")
    out = within.join(F.broadcast(starts), [group, "part"], "left")
    return out.select(*rows.columns, (F.col("place") + F.coalesce("before", F.lit(0))).alias("at"))
