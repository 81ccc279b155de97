"""Sending the package to the executors, which may not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Add the package as a Python archive to a session's context, once."""
    sc = spark.sparkContext
    if getattr(sc, "_spanmask_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="spanmask-"), "spanmask.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(PACKAGE)))
    sc.addPyFile(path)
    sc._spanmask_shipped = True
