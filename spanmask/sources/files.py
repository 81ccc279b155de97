"""File sources and sinks: JSON landing, lineage columns, parquet hop tables."""

from __future__ import annotations

import math
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.columns import q

# --- fixed values --------------------------------------------------------
# File-lineage columns added by with_file_metadata (names as Spark gives them).
FILE_METADATA_COLS = (
    "file_path", "file_name", "file_size", "file_block_start", "file_block_length", "file_modification_time",
)
# A landed share of more than this is several files, each written by a task of its own.
LANDED_MB = 32
# -------------------------------------------------------------------------


def ingest_json(spark: SparkSession, path: str, schema: Optional[T.StructType] = None,
                max_files: Optional[int] = None, stream: bool = True, infer_schema: bool = False,
                corrupt_column: Optional[str] = None) -> DataFrame:
    """JSON directory as a stream (or a batch with ``stream=False``).

    A stream needs ``schema`` unless ``infer_schema`` is set, which turns on
    ``spark.sql.streaming.schemaInference`` (types are then read from the
    files present when the query starts).  ``max_files`` caps files per
    micro-batch.  With ``corrupt_column`` (and a schema) a malformed line keeps its
    text in that string column; without it such a line is a row of nulls.
    """
    if corrupt_column and schema is not None and corrupt_column not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
    if stream and schema is None:
        if not infer_schema:
            raise ValueError("a JSON stream needs a schema, or infer_schema=True")
        spark.conf.set("spark.sql.streaming.schemaInference", "true")
    if stream:
        r = spark.readStream
        if schema is not None:
            r = r.schema(schema)
        if max_files:
            r = r.option("maxFilesPerTrigger", int(max_files))
        if corrupt_column:
            r = r.option("columnNameOfCorruptRecord", corrupt_column)
        return r.json(path)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if corrupt_column:
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    return r.json(path)


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Source columns + the six ``_metadata`` fields + ``processing_time``."""
    return df.select("*", "_metadata.*", F.current_timestamp().alias("processing_time"))


def write_json(df: DataFrame, path: str, parts: Optional[int] = None, mode: str = "append") -> None:
    """Batch JSON sink; ``parts`` files per write (round-robin repartition)."""
    out = df.repartition(parts) if parts else df
    out.write.mode(mode).json(path)


def table_bytes(df: DataFrame) -> int:
    """About the bytes of a table as JSON lines (names and cells, without escapes), by one pass over it."""
    cells = [F.coalesce(F.octet_length(q(c).cast("string")), F.lit(0)).cast("long") + len(c) + 6 for c in df.columns]
    return df.select(F.sum(sum(cells))).first()[0] or 0


def files_per_share(n_bytes: int, shares: int, landed_mb: float = LANDED_MB) -> int:
    """Files for each of ``shares`` equal shares of ``n_bytes``, so that none is much larger than ``landed_mb``."""
    return max(1, math.ceil(n_bytes / shares / (landed_mb * (1 << 20))))


def batch_files(spark: SparkSession, query: StreamingQuery, path: str, max_files: Optional[int]) -> Optional[int]:
    """Files of the hop table at ``path`` that hold about what one micro-batch of ``query``, which writes it, took in.

    A micro-batch is written in as many files as it has tasks.  A next hop that takes only ``max_files`` of them would run in so many
    tasks, and in more micro-batches the larger the input; with this limit it has those of ``query``.  Until ``query`` has
    run a micro-batch it is ``max_files`` for each task that the session runs at a time.
    """
    if not max_files:
        return max_files
    last = query.lastProgress
    batches = last.batchId + (1 if last.numInputRows else 0) if last else 0
    if not batches:
        return int(max_files) * spark.sparkContext.defaultParallelism
    return max(int(max_files), math.ceil(len(spark.read.schema("_ int").parquet(path).inputFiles()) / batches))


def read_hop(spark: SparkSession, path: Optional[str] = None, schema: Optional[T.StructType] = None, max_files: Optional[int] = None,
             table: Optional[str] = None) -> DataFrame:
    """Stream the append-only parquet table written by an upstream hop, ``max_files`` per micro-batch.

    By ``path`` and ``schema``, or by the name of a ``table`` of the catalog, which knows both.
    """
    r = spark.readStream.option("maxFilesPerTrigger", int(max_files)) if max_files else spark.readStream
    return r.table(table) if table else r.schema(schema).parquet(path)


def write_hop(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
              processing_time: Optional[str] = None, query_name: Optional[str] = None, table: Optional[str] = None) -> StreamingQuery:
    """Append a stream to a parquet table with its own checkpoint.

    ``available_now`` processes what has landed and stops; otherwise a
    ``processing_time`` trigger keeps the hop running.  The file sink with
    a checkpoint is exactly-once: a restarted hop neither drops nor
    repeats rows.  With ``table`` the folder is a table of the catalog by that name, made at the first start.
    """
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.option("path", path).toTable(table) if table else w.start(path)
