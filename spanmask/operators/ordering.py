"""The order of a sorted table as a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.config import shared_dir


def row_places(ordered: DataFrame, name: str = "place") -> DataFrame:
    """``ordered`` with the place (from 0) of each row in it.

    The rows are written once with the number of their task and their place in it; a sort deals ranges to tasks in order, so
    the rows of earlier tasks come before.  Only one count per task is added up, whatever the size of the table.
    """
    spark = ordered.sparkSession
    path = shared_dir(spark, "places")
    own = ordered.withColumn("_at", F.monotonically_increasing_id())
    own.write.mode("overwrite").parquet(path)
    rows = spark.read.schema(own.schema).parquet(path).withColumn("_part", F.shiftright("_at", 33))
    before = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = rows.groupBy("_part").count().select("_part", before.alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(starts), "_part").select(*ordered.columns, place.alias(name))
