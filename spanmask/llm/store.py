"""Tables written between two jobs of one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans.config import shared_dir


def fresh(name: str, df: DataFrame) -> str:
    """A column name like ``name`` that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written as Parquet to the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor costs at most the tasks of the job that
    was running, and a result that several later jobs use is computed once.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
