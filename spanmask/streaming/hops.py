"""Three append-only hops: raw -> analysed -> anonymised.

Each hop is a Structured Streaming query over the previous hop's parquet
table, with its own checkpoint, so each can restart on its own and the
file sink makes every hop exactly-once.  All operators on the way are
narrow projections (no state, no watermark needed), so append mode holds.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.anonymize import anonymize
from ..operators.scan import scan
from ..operators.distinct import K, distinct_parts, merge_distinct
from ..operators.summary import merge_parts, summary_parts
from ..plans.config import ScanConfig
from ..sources.evolving import ingest_json_evolving
from ..sources.files import FILE_METADATA_COLS, batch_files, ingest_json, read_hop, with_file_metadata, write_hop

LINEAGE_COLS = (*FILE_METADATA_COLS, "processing_time")
CORRUPT = "_corrupt_record"


@dataclass
class HopPaths:
    raw: str
    analysed: str
    anonymised: str
    checkpoints: str

    @classmethod
    def under(cls, root: str) -> "HopPaths":
        root = root.rstrip("/")
        return cls(f"{root}/customers_with_pii", f"{root}/customers_pii_analyzed",
                   f"{root}/customers_pii_anonymized", f"{root}/_checkpoints")


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def raw_stream(spark: SparkSession, landing: str, schema: T.StructType, max_files: Optional[int] = None) -> DataFrame:
    return with_file_metadata(ingest_json(spark, landing, schema, max_files, corrupt_column=CORRUPT))


def analysed_stream(raw: DataFrame, conf: ScanConfig, recognizers=None, detector=None) -> DataFrame:
    exclude = list(conf.cols_to_exclude) + [c for c in LINEAGE_COLS if c not in conf.cols_to_exclude]
    return scan(raw, exclude=exclude, known=conf.known_pii_cols, recognizers=recognizers or conf.entities,
                detector=detector, parallelism=conf.parallelism)


def run_hops(
    spark: SparkSession,
    landing: str,
    paths: HopPaths,
    schema: Optional[T.StructType],
    conf: ScanConfig,
    recognizers=None,
    operators: Optional[Mapping] = None,
    keep_analysed: bool = True,
    available_now: bool = True,
    processing_time: str = "30 seconds",
    detector=None,
    database: Optional[str] = None,
) -> list:
    """Run (or start) the hops; returns the streaming queries.

    With ``available_now`` each hop drains what has landed and stops, one
    after the other.  Otherwise all hops are started with a
    ``processing_time`` trigger and keep running.  ``keep_analysed=False``
    scans and rewrites in one hop, so raw text never lands in an analysed
    table.  ``conf.max_files`` bounds the landed files of each micro-batch; the later hops take about what one micro-batch of the
    hop before wrote (:func:`spanmask.sources.files.batch_files`).
    ``detector`` replaces the pattern recognisers.  A line that is no JSON keeps its
    text in ``_corrupt_record``, which is scanned and rewritten like any text.
    Without a ``schema`` types are inferred and logged under ``paths.checkpoints``, new fields are taken up at each start, and values
    that do not fit are kept in ``_rescued_data`` (see :mod:`spanmask.sources.evolving`), which is scanned as well.
    With ``database`` (an existing one; ``catalog.database`` too) the hops are tables there, named like their folders and read by name
    by the next hop; the schema of a catalog table does not grow, so a ``schema`` is needed.
    """
    if database and schema is None:
        raise ValueError("hops as catalog tables need a schema")
    named = lambda path: f"{database}.{path.rstrip('/').rsplit('/', 1)[-1]}" if database else None
    if schema is None:
        raw = ingest_json_evolving(spark, landing, f"{paths.checkpoints}/schema", max_files=conf.max_files)
    else:
        raw = raw_stream(spark, landing, schema, conf.max_files)
    raw_schema = _nullable(raw.schema)
    queries = []

    def go(df, path, name):
        q = write_hop(df, path, f"{paths.checkpoints}/{name}", available_now=available_now,
                      processing_time=None if available_now else processing_time, table=named(path))
        if available_now:
            q.awaitTermination()
        queries.append(q)
        return batch_files(spark, q, path, conf.max_files)

    limit = go(raw, paths.raw, "raw")
    hop1 = read_hop(spark, paths.raw, raw_schema, limit, named(paths.raw))
    if keep_analysed:
        analysed = analysed_stream(hop1, conf, recognizers, detector)
        limit = go(analysed, paths.analysed, "analysed")
        hop2 = read_hop(spark, paths.analysed, _nullable(analysed.schema), limit, named(paths.analysed))
        go(anonymize(hop2, operators=operators, parallelism=conf.parallelism), paths.anonymised, "anonymised")
    else:
        go(anonymize(analysed_stream(hop1, conf, recognizers, detector), operators=operators), paths.anonymised, "anonymised")
    return queries


def _parts_sink(stream: DataFrame, parts, path: str, checkpoint: str, available_now: bool):
    """Parts of every micro-batch in a ``batch_id=<n>`` folder of their own (``foreachBatch``); a replayed batch overwrites its folder."""

    def write(batch: DataFrame, batch_id: int):
        parts(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def summary_sink(scanned_stream: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Additive parts of the scan summary, per micro-batch; a restart counts nothing twice.

    :func:`read_summary` adds the parts up.
    """
    return _parts_sink(scanned_stream, summary_parts, path, checkpoint, available_now)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The scan summary of all micro-batches that :func:`summary_sink` has written."""
    return merge_parts(spark.read.parquet(path))


def distinct_sink(scanned_stream: DataFrame, path: str, checkpoint: str, k: int = K, available_now: bool = True):
    """Sketches of the distinct values per (column, entity type), per micro-batch; :func:`read_distinct` adds them up."""
    return _parts_sink(scanned_stream, lambda batch: distinct_parts(batch, k), path, checkpoint, available_now)


def read_distinct(spark: SparkSession, path: str, k: int = K) -> DataFrame:
    """Distinct values over all micro-batches that :func:`distinct_sink` has written with the same ``k``."""
    return merge_distinct(spark.read.parquet(path), k)


def run_pipeline(spark: SparkSession, conf: Optional[ScanConfig] = None, **options) -> list:
    """The hops as the session's configuration says (see :class:`ScanConfig`).

    ``ingestion_folder`` and ``output_folder`` must be set; without ``input_schema`` types are inferred, logged and evolved;
    ``options`` go to :func:`run_hops`.
    """
    conf = conf or ScanConfig.from_spark(spark)
    missing = [k for k in ("ingestion_folder", "output_folder") if not getattr(conf, k)]
    if missing:
        raise ValueError(f"not configured: {', '.join(missing)}")
    schema = T.StructType.fromDDL(conf.input_schema) if conf.input_schema else None
    return run_hops(spark, conf.ingestion_folder, HopPaths.under(conf.output_folder), schema, conf, **options)
