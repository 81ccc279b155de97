"""Job parameters and shared-storage locations, read from the session."""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass, field
from typing import Iterable, Optional

from pyspark.sql import SparkSession


def parse_list(value: Optional[str | Iterable[str]]) -> list[str]:
    """Comma-separated config value -> names; blanks dropped, spaces stripped.

    ``"".split(",")`` would give ``['']``, a column named empty string.
    """
    if value is None:
        return []
    items = value.split(",") if isinstance(value, str) else list(value)
    return [s.strip() for s in items if s and s.strip()]


@dataclass
class ScanConfig:
    """Typed view of the job configuration.

    Keys (``spark.conf``): ``ingestion_folder``, ``known_pii_cols``,
    ``cols_to_exclude``, ``pii_entities``, ``pii_parallelism``, ``output_folder``,
    ``input_schema`` (DDL), ``max_files_per_batch``.
    """

    ingestion_folder: Optional[str] = None
    known_pii_cols: list[str] = field(default_factory=list)
    cols_to_exclude: list[str] = field(default_factory=list)
    entities: Optional[list[str]] = None
    parallelism: Optional[int] = None
    output_folder: Optional[str] = None
    input_schema: Optional[str] = None
    max_files: Optional[int] = None

    @classmethod
    def from_spark(cls, spark: SparkSession, prefix: str = "") -> "ScanConfig":
        def get(key):
            return spark.conf.get(prefix + key, None)

        par = get("pii_parallelism")
        ents = get("pii_entities")
        return cls(
            ingestion_folder=get("ingestion_folder"),
            known_pii_cols=parse_list(get("known_pii_cols")),
            cols_to_exclude=parse_list(get("cols_to_exclude")),
            entities=parse_list(ents) if ents else None,
            parallelism=int(par) if par else None,
            output_folder=get("output_folder"),
            input_schema=get("input_schema"),
            max_files=int(get("max_files_per_batch")) if get("max_files_per_batch") else None,
        )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session.  Only where it is unset and all runs in one process
    (tests) a temporary folder is created and set; on a cluster each executor
    would write to its own disk, so there it must be given.  Returns the folder.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spanmask-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # some deployments reject core keys at run time
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint directory, in whatever store that is."""
    base = ensure_checkpoint_dir(spark)
    path = base.rstrip("/")
    for p in parts + (uuid.uuid4().hex[:12],):
        path = f"{path}/{p}"
    # These tables hold raw texts: the folder goes when the application ends.
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path
