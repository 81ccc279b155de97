"""Registered queries over the given tables, and their DuckDB twins.

Each query returns flat scalar rows (no arrays) so results can be compared
value by value; every computed column is aliased to the same name on both
sides.  All queries read whole tables and whole texts.
"""

from __future__ import annotations

import functools
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.context import Context
from ..functions.pseudonym import ROUNDS
from ..functions.recognizers import CREDIT_CARD, EMAIL, IP_ADDRESS, PHONE, SECRET, URL, Recognizer
from ..functions.spans import detect, detect_hits, resolve_spans
from ..functions.udf import python_regex_detector, python_regex_factory, register_row_detector
from ..operators.advise import FIRST, GROWTH, HIGH, LOW, Z, advise_columns
from ..operators.anonymize import anonymize, bucket_rows, deanonymize, spans_long, union_columns
from ..operators.columns import full_mask, q
from ..operators.gazetteer import FUZZY_LENGTH, FUZZY_SCORE, GAZETTEER_SCORE, PERSON_NAMES, PLACE_NAMES, add_gazetteer, fuzzy_spans, gazetteer_spans
from ..operators.distinct import distinct_values
from ..operators.ordering import row_places
from ..operators.sample import DIGEST, bottom_k
from ..operators.scan import scan
from ..operators.summary import summarize
from ..sources.evolving import ingest_json_evolving, read_evolved
from ..sources.files import batch_files, files_per_share, ingest_json, read_hop, table_bytes, with_file_metadata, write_hop, write_json
from ..sources.synth import synth_customers
from ..sources.tables import CUSTOMERS_WITH_PII_SQL, customer_sources, customers_with_pii, table
from ..streaming.hops import HopPaths, distinct_sink, read_distinct, read_summary, run_hops, run_pipeline, summary_sink
from ..streaming.identity import identity_sink, read_identity
from ..plans.config import ScanConfig, shared_dir
from . import oracle as O

# Recogniser sets used by the queries.
PATTERNS = [EMAIL, IP_ADDRESS, CREDIT_CARD, PHONE, SECRET]
# A deliberately overlapping recogniser (runs of 6+ digits sit inside
# cards and secret tokens) to exercise overlap resolution on real text.
DIGIT_RUN = Recognizer("DIGIT_RUN", "[0-9]{6,}", 0.3)

CWP = CUSTOMERS_WITH_PII_SQL
CWP_EXCLUDE = ["id", "segment"]
CWP_KNOWN = ["fullname"]
DOC_EXCLUDE = ["doc_id", "lang", "source", "n_chars"]

Query = Callable[[SparkSession, str], DataFrame]


# --- span rows --------------------------------------------------------------

def span_rows(df: DataFrame, key: str, column: str, recs, alias: str = "doc_id") -> DataFrame:
    hits = df.select(q(key).alias(alias), F.inline(detect_hits(q(column).cast("string"), recs)))
    return hits.select(alias, "entity_type", "start", "end", F.col("text").alias("matched"))


def _detect_query(rec: Recognizer, tbl: str = "documents", key: str = "doc_id", col: str = "text") -> Query:
    return lambda spark, d: span_rows(table(spark, d, tbl), key, col, [rec])


def _detect_sql(rec: Recognizer, tbl: str = "documents", key: str = "doc_id", col: str = "text") -> str:
    return (f"SELECT doc_id, entity_type, start, \"end\", matched FROM ("
            f"{O.span_rows(tbl, key, col, rec, key_alias='doc_id')})")


def _matched(rows: DataFrame) -> DataFrame:
    hit = F.col("text").substr(F.col("start") + 1, F.col("end") - F.col("start"))
    return rows.select("doc_id", "entity_type", "start", "end", hit.alias("matched"))


def detect_udf(spark, d):
    """The five patterns as a Python batch detector."""
    docs = table(spark, d, "documents")
    return _matched(docs.select("doc_id", "text", F.inline(python_regex_detector(PATTERNS)(F.col("text")))))


def detect_struct_udf(spark, d):
    """The same as a row detector: all columns cross to Python once."""
    s = scan(customers_with_pii(spark, d), exclude=CWP_EXCLUDE, recognizers=PATTERNS,
             row_detector=register_row_detector(python_regex_factory(PATTERNS)))
    return _per_column_counts(s)


def detect_two_tables(spark, d):
    """Columns of two joined tables, each with its own spans; no row of either is left out."""
    a, b = table(spark, d, "documents"), table(spark, d, "pages")
    joined = a.join(b, a["doc_id"] == b["page_id"], "full")
    sums = lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x["start"] + x["end"])
    j = joined.select(F.coalesce(a["doc_id"], b["page_id"]).alias("doc_id"), detect(a["text"], PATTERNS).alias("x"), detect(b["html"], PATTERNS).alias("y"))
    return j.select("doc_id", F.size("x").alias("n_text"), sums(F.col("x")).alias("sum_text"),
                    F.size("y").alias("n_html"), sums(F.col("y")).alias("sum_html"))


def _two_tables_sql() -> str:
    side = lambda tbl, key, col, n: (
        f"SELECT {key} AS k, count(*) AS n_{n}, sum(start + \"end\") AS sum_{n} FROM ("
        + " UNION ALL ".join(f"({O.span_rows(tbl, key, col, r)})" for r in PATTERNS) + f") GROUP BY {key}")
    return (f"SELECT coalesce(doc_id, page_id) AS doc_id, CAST(coalesce(n_text, 0) AS INTEGER) AS n_text, CAST(coalesce(sum_text, 0) AS INTEGER) AS sum_text, "
            f"CAST(coalesce(n_html, 0) AS INTEGER) AS n_html, CAST(coalesce(sum_html, 0) AS INTEGER) AS sum_html "
            f"FROM documents FULL JOIN pages ON doc_id = page_id "
            f"LEFT JOIN ({side('documents', 'doc_id', 'text', 'text')}) x ON x.k = doc_id "
            f"LEFT JOIN ({side('pages', 'page_id', 'html', 'html')}) y ON y.k = page_id")


SPOKEN = [EMAIL, PHONE.for_languages("en"), IP_ADDRESS.for_languages("de", "fr"), CREDIT_CARD.for_languages("es"), SECRET.for_languages()]


def detect_by_language(spark, d):
    """Recognisers limited to languages, by the documents' lang column."""
    s = scan(table(spark, d, "documents"), exclude=DOC_EXCLUDE, recognizers=SPOKEN, language="lang")
    return _matched(s.select("doc_id", "text", F.inline("pii_analysis_result.analysis_results.text")))


def _spoken_sql() -> str:
    sides = []
    for r in SPOKEN:
        where = f" WHERE lang IN ({', '.join(O.lit(x) for x in r.languages)})" if r.languages else ""
        sides.append(f"({O.span_rows(f'(SELECT doc_id, text FROM documents{where})', 'doc_id', 'text', r)})")
    return f"SELECT doc_id, entity_type, start, \"end\", matched FROM ({' UNION ALL '.join(sides)})"


# The tables' prose is invented, so the context words are common words of it.
NEARBY = {
    "PHONE_NUMBER": Context(("on", "st", "the"), ("de", "la", "le"), window=4),
    "CREDIT_CARD": Context(("are", "the", "this"), ("de", "et"), 0.2, 0.5, window=3),
    "SECRET_TOKEN": Context(("token",), ("en", "est"), 0.1, 0.3),
    "DIGIT_RUN": Context(("from", "token", "with"), ("the",), 0.8, 0.25, window=6),
}
SURE = 0.2


def context_scores(spark, d):
    """Spans with scores moved by the words around them; those under 0.2 go."""
    s = scan(table(spark, d, "documents"), exclude=DOC_EXCLUDE, recognizers=PATTERNS + [DIGIT_RUN], context=NEARBY, min_score=SURE)
    return s.select("doc_id", F.inline("pii_analysis_result.analysis_results.text")).select(
        "doc_id", "entity_type", "start", "end", F.round("score", 6).alias("score"))


def context_overlaps(spark, d):
    """Documents rewritten by the labels that the moved scores give to overlapping spans."""
    return anonymize(scan(table(spark, d, "documents"), exclude=DOC_EXCLUDE, recognizers=PATTERNS + [DIGIT_RUN], context=NEARBY, min_score=SURE)).select("doc_id", "text")


def scan_chunked(spark, d):
    """Documents of more than 256 characters cut into pieces of about that size, and the spans of the whole texts."""
    s = scan(table(spark, d, "documents"), exclude=DOC_EXCLUDE, recognizers=PATTERNS, strategy="chunked", key="doc_id", chunk=256)
    return _matched(s.select("doc_id", "text", F.inline("pii_analysis_result.analysis_results.text")))


def detect_span_order(spark, d):
    """The place of each span in its cell's array: by start, longest first, then type."""
    spans = detect(F.col("text"), PATTERNS + [DIGIT_RUN])
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(spans).alias("place", "s"))
    return rows.select("doc_id", F.col("place").cast("long").alias("place"), "s.entity_type", "s.start", "s.end")


def ordered_spans(spark, d):
    """All spans in one order over the whole table (type, text, document, start), and the place of each row in it.

    The place is that of the row in the sorted result, so it shows the order of the rows themselves.
    """
    rows = span_rows(table(spark, d, "documents"), "doc_id", "text", PATTERNS)
    return row_places(rows.orderBy("entity_type", "matched", "doc_id", "start"))


def detect_pages_html(spark, d):
    return span_rows(table(spark, d, "pages"), "page_id", "html", PATTERNS)


def scan_conversations(spark, d):
    s = scan(table(spark, d, "conversations"), exclude=["conv_id", "turn", "role"], recognizers=PATTERNS)
    return s.select("conv_id", "turn", "role", F.size("pii_analysis_result.analysis_results.text").alias("n_spans"))


def scan_events(spark, d):
    s = scan(table(spark, d, "events"), recognizers=PATTERNS, strings_only=True)
    found = F.col("pii_analysis_result.analysis_results")
    return s.select("event_id", F.size(found["props"]).alias("n_props"), F.size(found["event_type"]).alias("n_type"))


# --- scans ------------------------------------------------------------------

def _per_column_counts(scanned: DataFrame, key: str = "id") -> DataFrame:
    return union_columns(scanned, key).select(key, "column", F.size("spans").alias("n_spans"))


def scan_flat_all(spark, d):
    return _per_column_counts(scan(customers_with_pii(spark, d), recognizers=PATTERNS, layout="flat"))


def scan_flat_excluding(spark, d):
    return _per_column_counts(scan(customers_with_pii(spark, d), exclude=CWP_EXCLUDE, recognizers=PATTERNS,
                                   layout="flat"))


def scan_partitioned(spark, d):
    return _per_column_counts(scan(customers_with_pii(spark, d), exclude=CWP_EXCLUDE, recognizers=PATTERNS,
                                   layout="flat", parallelism=16))


def scan_stacked(spark, d):
    return _per_column_counts(scan(customers_with_pii(spark, d), exclude=CWP_EXCLUDE, recognizers=PATTERNS,
                                   layout="flat", strategy="stacked", key="id"))


def scan_nested(spark, d):
    s = scan(customers_with_pii(spark, d), exclude=CWP_EXCLUDE, known=CWP_KNOWN, recognizers=PATTERNS)
    s = s.withColumn("known_flag", F.col("pii_analysis_result.known_pii_columns.fullname"))
    return union_columns(s, "id", carry=["known_flag"]).select(
        "id", "column", F.size("spans").alias("n_spans"), "known_flag")


def _doc_counts(s: DataFrame) -> DataFrame:
    return s.select("doc_id", F.size(F.col("pii_analysis_result.analysis_results.text")).alias("n_spans"))


def scan_id_checked(spark, d):
    return _doc_counts(scan(table(spark, d, "documents"), exclude=DOC_EXCLUDE, recognizers=PATTERNS,
                            id_check=True, key="doc_id"))


def scan_id_debug(spark, d):
    s = scan(table(spark, d, "documents"), exclude=DOC_EXCLUDE, recognizers=PATTERNS, id_debug=True)
    # the debug id travels in the row and in the result; they must agree
    s = s.where(F.col("monotonic_id") == F.col("pii_analysis_result.monotonic_id"))
    return _doc_counts(s)


def scan_summary(spark, d):
    s = scan(customers_with_pii(spark, d), exclude=CWP_EXCLUDE, known=CWP_KNOWN, recognizers=PATTERNS)
    return summarize(s).withColumn("avg_score", F.round("avg_score", 6))


SAMPLE = 500


def sample_summary(spark, d):
    """The scan summary of a sample: the rows with the smallest md5 of the id, and only those, are scanned."""
    sample = bottom_k(customers_with_pii(spark, d), "id", SAMPLE).drop(DIGEST)
    s = scan(sample, exclude=CWP_EXCLUDE, known=CWP_KNOWN, recognizers=PATTERNS)
    return summarize(s).withColumn("avg_score", F.round("avg_score", 6))


ADVISED = (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("documents", "doc_id"), ("pages", "page_id"), ("events", "event_id"), ("benchmark", "item_id"))


def advise_tables(spark, d):
    """What to do with every string column of several tables, from a sample that grows until the column is decided."""
    parts = [advise_columns(table(spark, d, t), key, recognizers=PATTERNS + [URL]).select(F.lit(t).alias("table"), "*") for t, key in ADVISED]
    out = functools.reduce(DataFrame.unionByName, parts)
    return out.withColumns({c: F.round(c, 6) for c in ("hit_low", "hit_high", "whole_low", "whole_high")})


def _advise_sql() -> str:
    strings = {
        "customer": ["c_name", "c_mktsegment"], "supplier": ["s_name"], "documents": ["text", "lang", "source"], "pages": ["url", "html"],
        "events": ["event_type", "props"], "benchmark": ["text"]}
    return " UNION ALL ".join(
        f"({O.advice(t, t, key, c, PATTERNS + [URL], LOW, HIGH, Z, FIRST, GROWTH)})" for t, key in ADVISED for c in strings[t])


def distinct_entities(spark, d):
    """Different values of each entity type in each column."""
    s = scan(customers_with_pii(spark, d), exclude=CWP_EXCLUDE, known=CWP_KNOWN, recognizers=PATTERNS)
    return distinct_values(s)


def _distinct_sql(source: str, key: str, cols) -> str:
    return (f"SELECT \"column\", entity_type, count(DISTINCT matched) AS distinct_values, true AS exact FROM ({O.all_span_rows(source, key, cols, PATTERNS)}) "
            f"GROUP BY \"column\", entity_type")


def _flat_counts_sql(cols, recs) -> str:
    return " UNION ALL ".join(
        f"SELECT id, '{c}' AS \"column\", {O.count_expr(c, recs)} AS n_spans FROM {CWP}" for c in cols
    )


def _summary_sql(cols, recs, source: str = CWP) -> str:
    per = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{r.entity_type}' AS entity_type, {r.score!r} AS score, "
        f"{O.count_expr(c, [r])} AS n FROM {source}"
        for c in cols for r in recs
    )
    return (
        f"SELECT \"column\", entity_type, CAST(sum(n) AS DOUBLE) AS num_entities, "
        f"round(CAST(max(score) AS DOUBLE), 6) AS avg_score, CAST(count(*) AS BIGINT) AS sample_size, "
        f"CAST(sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS hit_rate "
        f"FROM ({per}) GROUP BY \"column\", entity_type HAVING sum(n) > 0"
    )


# --- overlaps and rewrite ------------------------------------------------------

def resolve_overlaps(spark, d):
    docs = table(spark, d, "documents")
    r = docs.select("doc_id", F.inline(resolve_spans(detect(F.col("text"), PATTERNS + [DIGIT_RUN]))))
    return r.select("doc_id", "start", "end", "entity_type")


def _rewritten(operators=None) -> Query:
    def run(spark, d):
        s = scan(table(spark, d, "documents"), exclude=DOC_EXCLUDE, recognizers=PATTERNS)
        return anonymize(s, operators=operators).select("doc_id", "text")

    return run


anonymize_documents = _rewritten()
PER_ENTITY = {"EMAIL_ADDRESS": "hash", "IP_ADDRESS": "mask", "CREDIT_CARD": "redact", "PHONE_NUMBER": ("replace", "[phone]"), "DEFAULT": "keep"}


def anonymize_customers(spark, d):
    s = scan(customers_with_pii(spark, d), exclude=CWP_EXCLUDE, known=CWP_KNOWN, recognizers=PATTERNS)
    return anonymize(s).select("id", "fullname", "segment", "freetext_1", "lang")


def anonymize_overlaps(spark, d):
    """Overlapping recognisers: the rewrite works on islands."""
    s = scan(table(spark, d, "documents"), exclude=DOC_EXCLUDE, recognizers=PATTERNS + [DIGIT_RUN])
    return anonymize(s).select("doc_id", "text")


def anonymize_gazetteer(spark, d):
    """Patterns and dictionary together; the dictionary by its join form."""
    s = scan(table(spark, d, "documents"), exclude=DOC_EXCLUDE, recognizers=PATTERNS)
    return anonymize(add_gazetteer(s, "doc_id", broadcast=False)).select("doc_id", "text")


PSEUDONYM_KEY = "catalogue key"


def pseudonyms(spark, d):
    """Card and phone numbers of the documents and what stands in their place."""
    s = scan(table(spark, d, "documents"), exclude=DOC_EXCLUDE, recognizers=[CREDIT_CARD, PHONE])
    hidden = anonymize(s, operators={"DEFAULT": ("pseudonym", PSEUDONYM_KEY)}, keep_result=True)
    rows = hidden.select("doc_id", F.col("text").alias("new"), F.inline("pii_analysis_result.analysis_results.text"))
    return rows.select("doc_id", "entity_type", "start", "end", F.col("new").substr(F.col("start") + 1, F.col("end") - F.col("start")).alias("pseudonym"))


def pseudonym_round_trip(spark, d):
    """Customers with pseudonyms of all entities and of the known column, and the same table restored by a second scan."""
    plan = {"exclude": CWP_EXCLUDE, "known": CWP_KNOWN, "recognizers": PATTERNS}
    key = ("pseudonym", PSEUDONYM_KEY)
    hidden = anonymize(scan(customers_with_pii(spark, d), **plan), operators={"DEFAULT": key}, known_operator=key)
    shown = deanonymize(hidden, PSEUDONYM_KEY, **plan).select("id", "fullname", F.col("freetext_1"), "lang")
    h = hidden.select("id", F.col("fullname").alias("_name"), F.col("freetext_1").alias("_text"))
    return shown.join(h, "id").select(
        "id", "fullname", "freetext_1", "lang", (F.col("_name") != F.col("fullname")).alias("name_hidden"),
        (F.col("_text") != F.col("freetext_1")).alias("text_hidden"), (F.length("_text") == F.length("freetext_1")).alias("same_length"))


def full_mask_query(spark, d):
    return full_mask(customers_with_pii(spark, d), CWP_KNOWN)


# --- long forms -------------------------------------------------------------

def _cwp_scanned(spark, d):
    return scan(customers_with_pii(spark, d), exclude=CWP_EXCLUDE, known=CWP_KNOWN, recognizers=PATTERNS)


def spans_long_query(spark, d):
    return spans_long(_cwp_scanned(spark, d), "id")


def union_columns_query(spark, d):
    return union_columns(_cwp_scanned(spark, d), "id").select("id", "column", "value",
                                                               F.size("spans").alias("n_spans"))


def bucket_rows_query(spark, d):
    return bucket_rows(_cwp_scanned(spark, d), "id", buckets=64)


# --- dictionary -------------------------------------------------------------

def gazetteer_query(spark, d):
    g = gazetteer_spans(table(spark, d, "documents"), "doc_id", "text")
    return g.select("doc_id", "term", "entity_type", "start", "end")


def _gazetteer_sql() -> str:
    values = ", ".join([f"('{n}', 'PERSON')" for n in PERSON_NAMES] + [f"('{n}', 'LOCATION')" for n in PLACE_NAMES])
    w = r"'\p{L}+'"
    return f"""
WITH t AS (SELECT doc_id, regexp_extract_all(text, {w}) AS m, string_split_regex(text, {w}) AS p FROM documents),
u AS (SELECT doc_id, i, m[i] AS tok, length(p[i]) + length(m[i]) AS step FROM t, unnest(range(1, len(m) + 1)) AS x(i)),
v AS (SELECT doc_id, tok, sum(step) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             - length(tok) AS start FROM u),
dict(term, entity_type) AS (VALUES {values})
SELECT v.doc_id, dict.term, dict.entity_type, CAST(v.start AS INTEGER) AS start,
       CAST(v.start + length(v.tok) AS INTEGER) AS "end"
FROM v JOIN dict ON lower(v.tok) = dict.term
"""


def fuzzy_query(spark, d):
    """Names and places with at most one typing error."""
    g = fuzzy_spans(table(spark, d, "documents"), "doc_id", "text")
    return g.select("doc_id", "word", "term", F.col("distance").cast("int").alias("distance"), "entity_type", "start", "end", F.round("score", 6).alias("score"))


def _fuzzy_sql() -> str:
    values = ", ".join([f"('{n}', 'PERSON')" for n in PERSON_NAMES] + [f"('{n}', 'LOCATION')" for n in PLACE_NAMES])
    w = r"'\p{L}+'"
    same = "(coalesce(list_position(list_transform(range(1, least(length(word), length(term)) + 1), lambda x: word[x] <> term[x]), true) - 1, least(length(word), length(term))))"
    return f"""
WITH t AS (SELECT doc_id, regexp_extract_all(text, {w}) AS m, string_split_regex(text, {w}) AS p FROM documents),
u AS (SELECT doc_id, i, m[i] AS tok, length(p[i]) + length(m[i]) AS step FROM t, unnest(range(1, len(m) + 1)) AS x(i)),
v AS (SELECT doc_id, tok, lower(tok) AS word, sum(step) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length(tok) AS start FROM u),
dict(term, entity_type) AS (VALUES {values}),
near AS (
  SELECT word, term, CASE WHEN word = term THEN 0 ELSE 1 END AS distance FROM (
    SELECT word, term, {same} AS k FROM (SELECT DISTINCT word FROM v) JOIN dict ON length(term) >= {FUZZY_LENGTH} AND abs(length(word) - length(term)) <= 1)
  WHERE word = term OR substr(word, k + 2) = substr(term, k + 2) AND length(word) = length(term)
    OR substr(word, k + 1) = substr(term, k + 2) AND length(word) < length(term) OR substr(word, k + 2) = substr(term, k + 1) AND length(word) > length(term))
SELECT doc_id, word, term, CAST(distance AS INTEGER) AS distance, entity_type, CAST(start AS INTEGER) AS start, CAST(start + length(tok) AS INTEGER) AS "end",
  round(CASE distance WHEN 0 THEN {GAZETTEER_SCORE} ELSE {GAZETTEER_SCORE} * {FUZZY_SCORE} END::DOUBLE, 6) AS score
FROM v JOIN near USING (word) JOIN dict USING (term)"""


def _union(recs, tbl: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    return " UNION ALL ".join(f"({O.span_rows(tbl, key, text, r)})" for r in recs)


def _nearby_sql() -> str:
    return O.rescored(_union(PATTERNS + [DIGIT_RUN]), "documents", "doc_id", "text", NEARBY, SURE)


# --- streams ----------------------------------------------------------------

def _land(df: DataFrame, landing: str, shares: int, *tables: DataFrame) -> int:
    """Land ``df`` as JSON in equal shares, which the streams take one or some at a time; the files of a share.

    A large share is several files, so that no task has it all to write; the micro-batches stay the same.
    A ``df`` joined from ``tables`` is as large as they are, and not joined to be measured.
    """
    files = files_per_share(sum(map(table_bytes, tables or (df,))), shares)
    write_json(df, landing, parts=shares * files)
    return files


def stream_ingest(spark, d):
    """Land the documents as JSON, stream them into a parquet hop, read it back with its lineage."""
    root = shared_dir(spark, "stream_ingest")
    landing = f"{root}/landing"
    share = _land(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), landing, 4)
    raw = with_file_metadata(ingest_json(spark, landing, T.StructType.fromDDL("id long, text string"), max_files=2 * share))
    write_hop(raw, f"{root}/raw", f"{root}/_checkpoints/raw").awaitTermination()
    hop = spark.read.parquet(f"{root}/raw")
    return hop.select(
        "id", "text", F.endswith("file_path", "file_name").alias("path_ends_in_name"), F.endswith("file_name", F.lit(".json")).alias("is_json"),
        F.col("file_block_start"), (F.col("file_block_length") == F.col("file_size")).alias("whole_file"),
        (F.col("file_modification_time") <= F.col("processing_time")).alias("written_before"),
    )


def stream_three_hop(spark, d):
    """Raw -> analysed -> anonymised over JSON landed from customers_with_pii, in several micro-batches."""
    root = shared_dir(spark, "stream_three_hop")
    cwp = customers_with_pii(spark, d)
    share = _land(cwp, f"{root}/landing", 6, *customer_sources(spark, d))
    conf = ScanConfig(ingestion_folder=f"{root}/landing", output_folder=f"{root}/out", known_pii_cols=CWP_KNOWN, cols_to_exclude=CWP_EXCLUDE,
                      input_schema=", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cwp.schema.fields), max_files=2 * share)
    run_pipeline(spark, conf, recognizers=PATTERNS)
    return spark.read.parquet(HopPaths.under(conf.output_folder).anonymised).select("id", "fullname", "segment", "freetext_1", "lang")


def stream_tables(spark, d):
    """The three hops as tables of the catalog, each read by name; two drops, so every stream restarts once."""
    root = shared_dir(spark, "stream_tables")
    base = "hops_" + root.rsplit("/", 1)[-1]
    spark.sql(f"CREATE DATABASE {base} LOCATION '{root}/base'")
    cwp = customers_with_pii(spark, d)
    customers, documents = customer_sources(spark, d)
    for half in (0, 1):
        share = _land(cwp.where(F.col("id") % 2 == half), f"{root}/landing", 3, customers.where(F.col("c_custkey") % 2 == half), documents.where(F.col("doc_id") % 2 == half))
        conf = ScanConfig(known_pii_cols=CWP_KNOWN, cols_to_exclude=CWP_EXCLUDE, max_files=2 * share)
        run_hops(spark, f"{root}/landing", HopPaths.under(f"{root}/out"), cwp.schema, conf, recognizers=PATTERNS, database=base)
    return spark.table(f"{base}.customers_pii_anonymized").select("id", "fullname", "segment", "freetext_1", "lang")


def stream_summary(spark, d):
    """Scan summary gathered per micro-batch (foreachBatch), one landed share each."""
    root = shared_dir(spark, "stream_summary")
    landing = f"{root}/landing"
    share = _land(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), landing, 4)
    st = ingest_json(spark, landing, T.StructType.fromDDL("id long, text string"), max_files=share)
    summary_sink(scan(st, exclude=["id"], recognizers=PATTERNS), f"{root}/summary", f"{root}/_checkpoints/summary")
    out = read_summary(spark, f"{root}/summary")
    return out.withColumn("avg_score", F.round("avg_score", 6))


def stream_distinct(spark, d):
    """Distinct values gathered as sketches per micro-batch, one landed share each."""
    root = shared_dir(spark, "stream_distinct")
    landing = f"{root}/landing"
    share = _land(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), landing, 4)
    st = ingest_json(spark, landing, T.StructType.fromDDL("id long, text string"), max_files=share)
    distinct_sink(scan(st, exclude=["id"], recognizers=PATTERNS), f"{root}/distinct", f"{root}/_checkpoints/distinct")
    return read_distinct(spark, f"{root}/distinct")


def stream_identity(spark, d):
    """Documents landed in two drops, an analysed hop with faults, and the check that finds them, over a restart of all three streams.

    The faults stand for a hop gone wrong: rows lost, repeated, and with the text of nobody.
    """
    root = shared_dir(spark, "stream_identity")
    schema = T.StructType.fromDDL("id long, text string")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")

    def hop(df, name):
        """The next stream of a hop's table, with the micro-batches that wrote it."""
        run = write_hop(df, f"{root}/{name}", f"{root}/_checkpoints/{name}")
        run.awaitTermination()
        return read_hop(spark, f"{root}/{name}", df.schema, batch_files(spark, run, f"{root}/{name}", 1))

    for half in (0, 1):
        share = _land(docs.where(F.col("id") % 2 == half), f"{root}/landing", 2)
        raw = hop(with_file_metadata(ingest_json(spark, f"{root}/landing", schema, max_files=share)), "raw")
        found = scan(raw, exclude=[c for c in raw.columns if c != "text"], recognizers=PATTERNS)
        times = F.when(F.col("id") % 7 == 3, 0).when(F.col("id") % 11 == 4, 2).otherwise(1)
        text = F.when(F.col("id") % 13 == 5, F.concat("text", F.lit("?"))).otherwise(F.col("text"))
        faulty = found.withColumn("text", text).withColumn("_n", F.explode(F.array_repeat(F.lit(1), times))).drop("_n")
        left = hop(faulty, "analysed")
        identity_sink(raw, left, ["id"], f"{root}/identity", f"{root}/_checkpoints/identity")
    found = read_identity(spark, f"{root}/identity")
    return found.select(F.get_json_object("row_key", "$[0]").cast("long").alias("doc_id"), "n_landed", "n_left", "status")


IDENTITY_SQL = """
SELECT doc_id, CAST(a AS BIGINT) AS n_landed, CAST(b AS BIGINT) AS n_left, CASE WHEN a = b THEN 'ok' WHEN a > b THEN 'missing' ELSE 'extra' END AS status
FROM (
  SELECT doc_id, 1 AS a, CASE WHEN other THEN 0 ELSE n END AS b FROM c
  UNION ALL SELECT doc_id, 0, n FROM c WHERE other AND n > 0)"""
IDENTITY_SQL = ("WITH c AS (SELECT doc_id, CASE WHEN doc_id % 7 = 3 THEN 0 WHEN doc_id % 11 = 4 THEN 2 ELSE 1 END AS n, doc_id % 13 = 5 AND text IS NOT NULL AS other "
                "FROM documents)" + IDENTITY_SQL)


def _land_events(spark, d, landing: str, drop: int) -> int:
    """A quarter of the events as JSON lines in two shares; each quarter knows other fields, and some of its user ids are text.  The files of a share."""
    events = table(spark, d, "events").where(F.col("event_id") % 4 == drop)
    fields = [F.col("event_id"), F.col("value")]
    if drop >= 1:
        fields.append(F.col("event_type"))
    if drop >= 2:
        fields.append(F.from_json("props", "k long").alias("props"))
    odd = F.to_json(F.struct(*fields, F.concat(F.lit("u"), F.col("user_id")).alias("user_id")))
    even = F.to_json(F.struct(*fields, F.col("user_id")))
    lines = events.select((F.when(F.col("user_id") % 2 == 1, odd).otherwise(even) if drop else even).alias("value"))
    files = files_per_share(table_bytes(lines), 2)
    lines.repartition(2 * files).write.mode("append").text(landing)
    return files


def stream_evolving(spark, d):
    """Events landed in four drops with growing fields and mistyped ids; three starts of one stream from its checkpoint.

    The third drop lands when the second run has its schema, so its new field is rescued; the third run has taken it up.
    """
    root = shared_dir(spark, "stream_evolving")
    landing, log = f"{root}/landing", f"{root}/_checkpoints/schema"
    start = lambda share: ingest_json_evolving(spark, landing, log, max_files=share)
    run = lambda stream: write_hop(stream, f"{root}/raw", f"{root}/_checkpoints/raw").awaitTermination()
    run(start(_land_events(spark, d, landing, 0)))
    second = start(_land_events(spark, d, landing, 1))
    _land_events(spark, d, landing, 2)
    run(second)
    run(start(_land_events(spark, d, landing, 3)))
    hop = read_evolved(spark, f"{root}/raw", log)
    return hop.select("event_id", "user_id", "value", "event_type", F.col("props.k").alias("props_k"), F.col("_rescued_data").alias("rescued"))


EVOLVED_SQL = """
SELECT event_id, CASE WHEN odd THEN NULL ELSE user_id END AS user_id, value, CASE WHEN drop >= 1 THEN event_type END AS event_type,
  CASE WHEN drop = 3 THEN k END AS props_k,
  CASE WHEN odd AND drop = 2 THEN '{"props":"{\\"k\\":' || k || '}","user_id":"u' || user_id || '"}'
    WHEN drop = 2 THEN '{"props":"{\\"k\\":' || k || '}"}' WHEN odd THEN '{"user_id":"u' || user_id || '"}' END AS rescued
FROM (SELECT *, event_id % 4 AS drop, event_id % 4 > 0 AND user_id % 2 = 1 AS odd, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"""


# --- synthetic data --------------------------------------------------------

def synth_query(spark, d):
    ids = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return synth_customers(spark, ids=ids, freetext_cols=2, seed=42)


# --- registry ---------------------------------------------------------------

def queries() -> dict[str, Query]:
    return {
        "detect_email_spans": _detect_query(EMAIL),
        "detect_ip_spans": _detect_query(IP_ADDRESS),
        "detect_phone_spans": _detect_query(PHONE),
        "detect_secret_spans": _detect_query(SECRET),
        "detect_card_spans": _detect_query(CREDIT_CARD),
        "detect_url_spans": _detect_query(URL, "pages", "page_id", "url"),
        "detect_udf": detect_udf,
        "detect_struct_udf": detect_struct_udf,
        "detect_two_tables": detect_two_tables,
        "detect_pages_html": detect_pages_html,
        "detect_by_language": detect_by_language,
        "detect_span_order": detect_span_order,
        "ordered_spans": ordered_spans,
        "scan_conversations": scan_conversations,
        "scan_events": scan_events,
        "scan_flat_all": scan_flat_all,
        "scan_flat_excluding": scan_flat_excluding,
        "scan_partitioned": scan_partitioned,
        "scan_stacked": scan_stacked,
        "scan_chunked": scan_chunked,
        "context_scores": context_scores,
        "context_overlaps": context_overlaps,
        "scan_nested": scan_nested,
        "scan_id_checked": scan_id_checked,
        "scan_id_debug": scan_id_debug,
        "scan_summary": scan_summary,
        "sample_summary": sample_summary,
        "advise_columns": advise_tables,
        "distinct_entities": distinct_entities,
        "resolve_overlaps": resolve_overlaps,
        "anonymize_documents": anonymize_documents,
        "anonymize_customers": anonymize_customers,
        "anonymize_redact": _rewritten({"DEFAULT": "redact"}),
        "anonymize_hash": _rewritten({"DEFAULT": "hash"}),
        "anonymize_mask": _rewritten({"DEFAULT": "mask"}),
        "anonymize_keep": _rewritten({"DEFAULT": "keep"}),
        "anonymize_per_entity": _rewritten(PER_ENTITY),
        "anonymize_overlaps": anonymize_overlaps,
        "anonymize_gazetteer": anonymize_gazetteer,
        "pseudonyms": pseudonyms,
        "pseudonym_round_trip": pseudonym_round_trip,
        "full_mask": full_mask_query,
        "spans_long": spans_long_query,
        "union_columns": union_columns_query,
        "bucket_rows": bucket_rows_query,
        "gazetteer_spans": gazetteer_query,
        "gazetteer_fuzzy": fuzzy_query,
        "stream_ingest": stream_ingest,
        "stream_three_hop": stream_three_hop,
        "stream_tables": stream_tables,
        "stream_summary": stream_summary,
        "stream_distinct": stream_distinct,
        "stream_evolving": stream_evolving,
        "stream_identity": stream_identity,
        "synth_customers": synth_query,
    }


def oracle_sql() -> dict[str, str]:
    all_cols = ["id", "fullname", "segment", "freetext_1", "lang"]
    scanned = ["fullname", "freetext_1", "lang"]
    cwp_anon = (f"SELECT id, CAST({O.MASKED} AS VARCHAR) AS fullname, segment, freetext_1, lang FROM ("
                + O.rewrite(_union(PATTERNS, CWP, "id", "freetext_1"), CWP, "id", "freetext_1", O.REPLACE, "segment,lang") + ")")
    docs = lambda replacement, recs=PATTERNS: O.rewrite(_union(recs), "documents", "doc_id", "text", replacement)
    per_entity = (f"CASE g.entity_type WHEN 'EMAIL_ADDRESS' THEN {O.HASH} WHEN 'IP_ADDRESS' THEN {O.MASK} WHEN 'CREDIT_CARD' THEN '' "
                  f"WHEN 'PHONE_NUMBER' THEN '[phone]' ELSE {O.KEEP} END")
    with_names = (f"{_union(PATTERNS)} UNION ALL (SELECT doc_id, entity_type, start, \"end\", "
                  f"CAST({GAZETTEER_SCORE} AS DOUBLE) AS score, NULL AS matched FROM ({_gazetteer_sql()}))")
    doc_counts = f"SELECT doc_id, {O.count_expr('text', PATTERNS)} AS n_spans FROM documents"
    return {
        "detect_email_spans": _detect_sql(EMAIL),
        "detect_ip_spans": _detect_sql(IP_ADDRESS),
        "detect_phone_spans": _detect_sql(PHONE),
        "detect_secret_spans": _detect_sql(SECRET),
        "detect_card_spans": _detect_sql(CREDIT_CARD),
        "detect_url_spans": _detect_sql(URL, "pages", "page_id", "url"),
        "detect_udf": f"SELECT doc_id, entity_type, start, \"end\", matched FROM ({_union(PATTERNS)})",
        "detect_struct_udf": _flat_counts_sql(scanned, PATTERNS),
        "detect_two_tables": _two_tables_sql(),
        "detect_pages_html": f"SELECT page_id AS doc_id, entity_type, start, \"end\", matched FROM ({_union(PATTERNS, 'pages', 'page_id', 'html')})",
        "detect_by_language": _spoken_sql(),
        "detect_span_order": (
            "SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY start, \"end\" DESC, entity_type) - 1 AS place, "
            f"entity_type, start, \"end\" FROM ({_union(PATTERNS + [DIGIT_RUN])})"),
        "ordered_spans": (
            f"SELECT doc_id, entity_type, start, \"end\", matched, row_number() OVER (ORDER BY entity_type, matched, doc_id, start) - 1 AS place FROM ({_union(PATTERNS)})"),
        "scan_conversations": f"SELECT conv_id, turn, role, {O.count_expr('text', PATTERNS)} AS n_spans FROM conversations",
        "scan_events": f"SELECT event_id, {O.count_expr('props', PATTERNS)} AS n_props, {O.count_expr('event_type', PATTERNS)} AS n_type FROM events",
        "scan_flat_all": _flat_counts_sql(all_cols, PATTERNS),
        "scan_flat_excluding": _flat_counts_sql(scanned, PATTERNS),
        "scan_partitioned": _flat_counts_sql(scanned, PATTERNS),
        "scan_stacked": _flat_counts_sql(scanned, PATTERNS),
        "scan_chunked": f"SELECT doc_id, entity_type, start, \"end\", matched FROM ({_union(PATTERNS)})",
        "context_scores": f"SELECT doc_id, entity_type, start, \"end\", round(score, 6) AS score FROM ({_nearby_sql()})",
        "context_overlaps": O.rewrite(_nearby_sql(), "documents", "doc_id", "text", O.REPLACE),
        "scan_nested": f"SELECT id, \"column\", n_spans, 'Full mask' AS known_flag FROM ("
                       f"{_flat_counts_sql(['freetext_1', 'lang'], PATTERNS)})",
        "scan_id_checked": doc_counts,
        "scan_id_debug": doc_counts,
        "scan_summary": _summary_sql(["freetext_1", "lang"], PATTERNS),
        "sample_summary": _summary_sql(["freetext_1", "lang"], PATTERNS, f"(SELECT * FROM {CWP} ORDER BY md5(CAST(id AS VARCHAR)) LIMIT {SAMPLE})"),
        "advise_columns": _advise_sql(),
        "distinct_entities": _distinct_sql(CWP, "id", ["freetext_1", "lang"]),
        "stream_distinct": _distinct_sql("documents", "doc_id", ["text"]),
        "resolve_overlaps": O.islands(_union(PATTERNS + [DIGIT_RUN]), "doc_id"),
        "anonymize_documents": docs(O.REPLACE),
        "anonymize_customers": cwp_anon,
        "anonymize_redact": docs(O.REDACT),
        "anonymize_hash": docs(O.HASH),
        "anonymize_mask": docs(O.MASK),
        "anonymize_keep": docs(O.KEEP),
        "anonymize_per_entity": docs(per_entity),
        "anonymize_overlaps": docs(O.REPLACE, PATTERNS + [DIGIT_RUN]),
        "anonymize_gazetteer": O.rewrite(with_names, "documents", "doc_id", "text", O.REPLACE),
        "pseudonyms": O.pseudonyms(_union([CREDIT_CARD, PHONE]), PSEUDONYM_KEY, ROUNDS),
        "pseudonym_round_trip": f"SELECT id, fullname, freetext_1, lang, fullname IS NOT NULL OR NULL AS name_hidden, "
                                f"{O.count_expr('freetext_1', PATTERNS)} > 0 AND freetext_1 IS NOT NULL OR CASE WHEN freetext_1 IS NULL THEN NULL ELSE false END AS text_hidden, "
                                f"CASE WHEN freetext_1 IS NOT NULL THEN true END AS same_length FROM {CWP}",
        "full_mask": f"SELECT id, {O.MASKED} AS fullname, segment, freetext_1, lang FROM {CWP}",
        "spans_long": f"SELECT id, \"column\", entity_type, start, \"end\", score, matched FROM ("
                      f"{O.all_span_rows(CWP, 'id', ['freetext_1', 'lang'], PATTERNS)})",
        "union_columns": " UNION ALL ".join(
            f"SELECT id, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, {O.count_expr(c, PATTERNS)} AS n_spans "
            f"FROM {CWP}" for c in ["freetext_1", "lang"]),
        "bucket_rows": (
            "SELECT CAST(id % 64 AS BIGINT) AS bucket, \"column\", CAST(count(*) AS BIGINT) AS n_rows, "
            "CAST(sum(n_spans) AS BIGINT) AS n_spans FROM ("
            + _flat_counts_sql(["freetext_1", "lang"], PATTERNS) + ") GROUP BY 1, 2"),
        "gazetteer_spans": _gazetteer_sql(),
        "gazetteer_fuzzy": _fuzzy_sql(),
        "stream_ingest": "SELECT doc_id AS id, text, true AS path_ends_in_name, true AS is_json, "
                         "CAST(0 AS BIGINT) AS file_block_start, true AS whole_file, true AS written_before FROM documents",
        "stream_three_hop": cwp_anon,
        "stream_tables": cwp_anon,
        "stream_evolving": EVOLVED_SQL,
        "stream_identity": IDENTITY_SQL,
        "stream_summary": _summary_sql(["text"], PATTERNS, "documents"),
        "synth_customers": O.synth_customers("(SELECT c_custkey AS id FROM customer)", 2, 42),
    }
