"""Identity check of a stream: every landed row leaves a hop once, with its own cells.

The scan of a table can be checked by a join on a row id (``scan(id_check=True)``); a stream has no such join that would
end.  Here both hop tables are read as streams and counted together in the state store: per row key, landing time and hash of the landed
columns, how often the row landed and how often it left the hop.  The counts are updated with each micro-batch, so the verdict on
each row is known at any time, over restarts: the state is restored from the checkpoint, and a replayed batch overwrites its
own output.

The state is bounded: both sides carry the landing time (``processing_time``) that the first hop gave the row, and counts
older than the watermark go.  The watermark follows the slower of the two streams, less ``delay``; a row that leaves
later than that is not counted any more.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import q

LANDED_AT = "processing_time"
_COLUMNS = ("row_key", "landed_at", "mark")


def _side(hop: DataFrame, key: Sequence[str], columns: Sequence[str], delay: str, landed: int) -> DataFrame:
    types = {f.name: f.dataType for f in hop.schema.fields}
    cells = [F.to_json(q(c)) if isinstance(types[c], T.MapType) else q(c) for c in columns]
    # A null must not hash like the column left out: the nulls are part of the hash.
    nulls = F.concat(*[F.when(q(c).isNull(), "1").otherwise("0") for c in columns]) if columns else F.lit("")
    return hop.select(
        F.to_json(F.array(*[q(c).cast("string") for c in key])).alias("row_key"), q(LANDED_AT).alias("landed_at"),
        F.xxhash64(nulls, *cells).alias("mark"), F.lit(landed).cast("long").alias("l"), F.lit(1 - landed).cast("long").alias("o"),
    ).withWatermark("landed_at", delay)


def identity_counts(landed: DataFrame, left: DataFrame, key: Sequence[str], delay: str = "1 day") -> DataFrame:
    """Counts per row of two hop streams: ``row_key`` (JSON array), ``landed_at``, ``mark``, ``n_landed``, ``n_left``.

    ``left`` must have all columns of ``landed`` (others, such as the scan result, are not looked at).  Equal rows that landed
    together are counted together.  Use output mode ``update``.
    """
    columns = [c for c in landed.columns if c != LANDED_AT]
    missing = [c for c in [*columns, LANDED_AT] if c not in left.columns or c not in landed.columns]
    if missing:
        raise ValueError(f"the hop lacks {', '.join(missing)}")
    both = _side(landed, key, columns, delay, 1).unionByName(_side(left, key, columns, delay, 0))
    return both.groupBy(*_COLUMNS).agg(F.sum("l").alias("n_landed"), F.sum("o").alias("n_left"))


def identity_sink(landed: DataFrame, left: DataFrame, key: Sequence[str], path: str, checkpoint: str, delay: str = "1 day",
                  available_now: bool = True, processing_time: str = "30 seconds"):
    """Run :func:`identity_counts` and keep the changed counts of every micro-batch in a folder of its own."""

    def write(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    w = identity_counts(landed, left, key, delay).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    q_ = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()
    if available_now:
        q_.awaitTermination()
    return q_


def read_identity(spark: SparkSession, path: str) -> DataFrame:
    """The last counts of every row and what they say.

    ``status`` is ``ok`` (left as often as it landed), ``missing`` (landed more often: lost, or still on its way) or ``extra``
    (left more often).  A row that left with other cells than its own is one of each.
    """
    schema = "row_key string, landed_at timestamp, mark bigint, n_landed bigint, n_left bigint, batch_id bigint"
    last = spark.read.schema(schema).parquet(path).groupBy(*_COLUMNS).agg(F.max_by(F.struct("n_landed", "n_left"), "batch_id").alias("n"))
    status = F.when(F.col("n_landed") == F.col("n_left"), "ok").when(F.col("n_landed") > F.col("n_left"), "missing").otherwise("extra")
    return last.select(*_COLUMNS, "n.*").withColumn("status", status)
