"""A training corpus from ``documents`` in five stages.

Language ID, line dedup, near-dedup, benchmark decontamination, packing.  Each stage takes the rows
that its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanmask.llm import decontam, langid, line_dedup, near_dedup, packing
from spanmask.llm.queries import TOKENIZER
from spanmask.llm.store import fresh, written

#: The stage links from a similarity of 0.8 on; 27 bands of 4 miss a pair at exactly 0.8 with probability below 1e-6.
NEAR = {"num": 80, "den": 100, "bands": 27, "rows": 4}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without text or a letter go."""
    prefix = "_" * (1 + max(map(len, docs.columns)))    # no column has such a name
    out = langid.identify(docs, keep=tuple(docs.columns), prefix=prefix)
    return out.where(F.col(f"{prefix}lang_pred") != "und").select(*docs.columns)


def line_cleaning(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines leave the texts; every document stays, and n_chars follows its text.

    Pages of equal text count once: copies go in the next stage, and one of them must keep its lines.
    """
    out = line_dedup.drop_boilerplate(docs, counts=False, fold=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def _row_keys(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column of long row keys, and its name: doc_id, or a number that no doc_id has for each row without one.

    The numbers are above all doc_ids, so that rows with a doc_id come first; below them if there is no room.
    """
    key, part, start = (fresh(name, docs) for name in ("_row", "_part", "_start"))
    ids = F.col("doc_id").cast("long")
    least, most, nulls = docs.agg(F.min(ids), F.max(ids), F.count_if(ids.isNull())).first()
    if not nulls:
        return docs.withColumn(key, ids), key
    first = 0 if most is None else most + 1 if most + nulls < 1 << 63 else least - nulls
    if first < -(1 << 63):
        raise ValueError("rows without a doc_id: no numbers left beside the doc_ids")
    # Written, so that all jobs see the same numbers; their upper bits are the task's, and counts per task close the gaps.
    rows = written(docs.where(ids.isNull()).withColumn(key, F.monotonically_increasing_id()), "rows_without_id")
    rows = rows.withColumn(part, F.shiftright(key, 33)).withColumn(key, F.col(key).bitwiseAND((1 << 33) - 1))
    before = F.sum("count").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.groupBy(part).count().select(part, F.coalesce(before, F.lit(0)).alias(start))
    rows = rows.join(F.broadcast(starts), part).withColumn(key, F.lit(first).cast("long") + F.col(start) + F.col(key))
    return docs.where(ids.isNotNull()).withColumn(key, ids).unionByName(rows.drop(part, start)), key


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group stays; documents link from a similarity of 0.8 on.

    Of rows with equal doc_id and text one stays.  Each row without a doc_id is a document of its own, after those with one.
    """
    rows, key = _row_keys(docs)
    marks = near_dedup.near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), **NEAR)
    gone = written(marks.where("not kept").select(F.col("doc_id").alias(key)).distinct(), "gone")
    kept = rows.join(gone, key, "left_anti")
    several = written(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key), "several_rows")
    if not several.isEmpty():
        kept = kept.join(several, key, "left_anti").unionByName(kept.join(several, key, "left_semi").dropDuplicates([key, "text"]))
    return kept.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go, those without a doc_id too."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    rows, key = _row_keys(docs)
    leaks = decontam.leaks(rows.select(F.col(key).alias("doc_id"), "text"), benchmark)
    gone = written(leaks.select(F.col("doc_id").alias(key)).distinct(), "leaks")
    return rows.join(gone, key, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_cleaning),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: SQL expresses neither the language model nor the sketches; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
