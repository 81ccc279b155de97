"""Queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import conversations, decontam, exact, html_text, langid, line_dedup, merkle, near_dedup, packing, quality, substring, twins, url_rules, wavelet

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition(_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, url_rules.page_labels(pages, _table(spark, sf_dir, "labels")))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.cut_repeats(_table(spark, sf_dir, "documents"), texts=False)


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_output(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damaged(rows), ids=rows)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"), merkle.lower_cased())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_dedup, op2_packing, op3_quality, op4_decontamination, op5_url_filter, op6_html_text,
        op7_language_id, op8_line_dedup, op9_substring_dedup, op10_token_output,
        op11_exact_dedup, op12_conversation_repair, op13_merkle_manifest,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op8_line_dedup": f"""
WITH d AS (
  SELECT doc_id, source, text, coalesce(source, '') AS host, string_split(text, chr(10)) AS lines
  FROM documents
), totals AS (SELECT host, count(*) AS pages FROM d GROUP BY host),
l AS (SELECT DISTINCT host, doc_id, trim(unnest(lines), ' ') AS line FROM d),
b AS (
  SELECT host, line FROM (SELECT host, line, count(*) AS n FROM l WHERE line <> '' GROUP BY host, line) c JOIN totals USING (host)
  WHERE n >= {line_dedup.MIN_PAGES} AND n > {line_dedup.RATIO}::DOUBLE * pages
), g AS (SELECT host, list(line) AS drops FROM b GROUP BY host)
SELECT doc_id, source,
  CASE WHEN drops IS NULL THEN text
       ELSE array_to_string(list_filter(lines, lambda x: NOT list_contains(drops, trim(x, ' '))), chr(10)) END AS text,
  coalesce(len(list_filter(lines, lambda x: trim(x, ' ') <> '')), 0)::BIGINT AS n_lines,
  CASE WHEN drops IS NULL OR text IS NULL THEN 0 ELSE len(list_filter(lines, lambda x: list_contains(drops, trim(x, ' ')))) END::BIGINT AS n_dropped
FROM d LEFT JOIN g USING (host)""",
    "op11_exact_dedup": twins.EXACT,
    "op12_conversation_repair": twins.repair(),
    "op13_merkle_manifest": twins.manifest(),
}
