"""Table-level anonymise: rewrite analysed columns, mask known ones.

One narrow projection per table, for batch and stream alike: each analysed
cell is rewritten from its own row's spans, so no bucket, union, pivot or
join-back is needed, and a repeated or missing row id cannot misalign
values.  Stateless, so a stream runs in append mode.
"""

from __future__ import annotations

from typing import Mapping, Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pseudonym import pseudonym
from ..functions.recognizers import PII_MASKED
from ..functions.rewrite import anonymize_cells, anonymize_text
from ..functions.spans import SPANS_TYPE
from .columns import RESULT_COL, q, result_columns, spans_col


def anonymize(
    df: DataFrame,
    operators: Optional[Mapping] = None,
    parallelism: Optional[int] = None,
    token: str = PII_MASKED,
    mask_nulls: bool = True,
    result_col: str = RESULT_COL,
    keep_result: bool = False,
    known_operator: Optional[tuple] = None,
) -> DataFrame:
    """Anonymise a scanned table (either result layout).

    Analysed columns are rewritten at their spans (``operators`` per entity
    type, default ``<ENTITY_TYPE>``); known columns become ``token``; every
    other column, and the column order, is unchanged, and so are the types of the
    analysed columns: a cell that is not a string keeps its value, or is null if
    anything was found in it.  The result column
    is dropped unless ``keep_result``.  ``parallelism`` repartitions
    before the rewrite, never after it.  With ``known_operator`` = ``("pseudonym", key)`` (or ``("restore", key)``) known
    columns of text get pseudonyms of their values in place of ``token``; null cells stay null.
    """
    analysed, known = result_columns(df, result_col)
    known_set, analysed_set = set(known), set(analysed)
    base = df.repartition(parallelism) if parallelism else df
    texts = [c for c in df.columns if c in analysed_set and isinstance(df.schema[c].dataType, T.StringType)]
    if len(texts) > 1:      # one rewrite expression for all of them; a name that no column has
        cells = "_" * (1 + max(map(len, df.columns)))
        base = base.withColumn(cells, anonymize_cells([(q(c), spans_col(df, c, result_col)) for c in texts], operators))
        new = {c: F.col(cells)[i] for i, c in enumerate(texts)}
    else:
        new = {c: anonymize_text(q(c), spans_col(df, c, result_col), operators) for c in texts}
    out = []
    for c in df.columns:
        if c == result_col:
            if keep_result:
                out.append(F.col(result_col))
            continue
        if c in known_set:
            if known_operator and isinstance(df.schema[c].dataType, T.StringType):
                out.append(pseudonym(q(c), known_operator[1], c, known_operator[0] == "restore").alias(c))
            elif mask_nulls:
                out.append(F.lit(token).alias(c))
            else:
                out.append(F.when(q(c).isNull(), F.lit(None).cast("string")).otherwise(F.lit(token)).alias(c))
        elif c in analysed_set:
            found = F.coalesce(F.size(spans_col(df, c, result_col)), F.lit(0)) > 0
            out.append((new[c] if c in new else F.when(~found, q(c))).alias(c))
        else:
            out.append(q(c))
    return base.select(*out)


def deanonymize(df: DataFrame, key: str, exclude=(), known=(), recognizers=None, entities=None, result_col: str = RESULT_COL, **scan_options) -> DataFrame:
    """The table behind one whose hits were replaced by keyed pseudonyms.

    A pseudonym keeps its value's format, so a scan with the same columns and recognisers finds it where the value was; it is
    then undone with ``key``.  ``entities`` names the types that got pseudonyms (default: all).  ``known`` columns must have
    got theirs with ``known_operator``.
    """
    from .scan import scan

    undo = ("restore", key)
    operators = {"DEFAULT": undo} if entities is None else {"DEFAULT": "keep"} | {e: undo for e in entities}
    scanned = scan(df, exclude, known, recognizers=recognizers, result_col=result_col, **scan_options)
    return anonymize(scanned, operators=operators, result_col=result_col, known_operator=undo)


def scan_and_anonymize(df: DataFrame, exclude=(), known=(), recognizers=None, detector=None,
                       operators=None, parallelism=None, **kw) -> DataFrame:
    """Scan and rewrite in one hop: the raw text never lands in an analysed table."""
    from .scan import scan

    return anonymize(scan(df, exclude, known, recognizers=recognizers, detector=detector,
                          parallelism=parallelism, **kw), operators=operators)


# --- long forms ----------------------------------------------------------

def union_columns(df: DataFrame, key: str, result_col: str = RESULT_COL, carry=()) -> DataFrame:
    """Long form of a scanned table: one row per (key, analysed column).

    Columns: ``key, *carry, column, value (string), spans``.  One pass over
    the input: each row emits an array of per-column structs that is
    inlined, so the scan (and anything under it) runs once, not once per
    column as a union of projections would.
    """
    analysed, _ = result_columns(df, result_col)
    if not analysed:
        raise ValueError("no analysed columns")
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            q(c).cast("string").alias("value"),
            F.coalesce(spans_col(df, c, result_col), F.array().cast(SPANS_TYPE)).alias("spans"),
        )
        for c in analysed
    ])
    return df.select(q(key).alias(key), *[q(c).alias(c) for c in carry], F.inline(cells))


def spans_long(df: DataFrame, key: str, result_col: str = RESULT_COL, with_text: bool = True) -> DataFrame:
    """One row per span: ``key, column, entity_type, start, end, score[, matched]``."""
    long = union_columns(df, key, result_col)
    rows = long.select(key, "column", "value", F.inline("spans"))
    cols = [key, "column", "entity_type", "start", "end", "score"]
    if with_text:
        return rows.select(*cols, F.col("value").substr(F.col("start") + 1, F.col("end") - F.col("start")).alias("matched"))
    return rows.select(*cols)


def bucket_rows(df: DataFrame, key: str, buckets: int = 1024, result_col: str = RESULT_COL) -> DataFrame:
    """Per ``key % buckets``: rows and spans, per analysed column.

    Gathering a bucket into lists would hold it whole in one task; the
    rewrite here is row-wise, so a bucket is only ever counted.  The
    counts are partial aggregates, so a hot bucket is combined map-side
    and never held in one task.  Columns: ``bucket, column, n_rows, n_spans``.
    """
    long = union_columns(df, key, result_col)
    return long.groupBy(F.pmod(q(key), F.lit(buckets)).alias("bucket"), "column").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.size("spans")).alias("n_spans"),
    )
