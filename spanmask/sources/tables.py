"""Reading the given parquet tables and the fixtures derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What :func:`customers_with_pii` joins: customers and documents, without the columns that it leaves out."""
    return (table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"),
            table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def customers_with_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer FULL JOIN documents ON c_custkey = doc_id``: no row of either is left out.

    id (excluded), fullname (known PII), segment (excluded), freetext_1
    (scanned), lang (scanned, clean); null where a side is missing.  Both keys
    are unique, and so is id.
    """
    c, d = customer_sources(spark, sf_dir)
    return c.join(d, c.c_custkey == d.doc_id, "full").select(
        F.coalesce("c_custkey", "doc_id").alias("id"),
        F.col("c_name").alias("fullname"),
        F.col("c_mktsegment").alias("segment"),
        F.col("text").alias("freetext_1"),
        F.col("lang"),
    )


CUSTOMERS_WITH_PII_SQL = (
    "(SELECT coalesce(c.c_custkey, d.doc_id) AS id, c.c_name AS fullname, c.c_mktsegment AS segment, "
    "d.text AS freetext_1, d.lang AS lang FROM customer c FULL JOIN documents d ON c.c_custkey = d.doc_id)"
)
