"""Table scan: add one result column holding the spans of every scanned cell.

Default strategy ``columns`` is a single narrow projection: Spark evaluates
the span expression of each column next to the file reader, so there is no
shuffle and nothing leaves the JVM.  ``parallelism`` adds a round-robin
repartition *before* the heavy stage, for inputs with too few splits (a
stream of a few files).  ``stacked`` turns a wide table into one
(row key, column) pair per row so the work of very uneven columns spreads
evenly; only keys and spans come back, in one grouping and one join, so it is batch only.
``chunked`` cuts very long cells and leaves all others to the narrow projection.
"""

from __future__ import annotations

from typing import Callable, Mapping, Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.context import Context, rescore, rescore_cells
from ..functions.spans import SPANS_TYPE, as_recognizers, concat_spans, detect, detect_cells
from .chunked import CHUNK, scan_chunked
from .columns import RESULT_COL, ColumnPlan, pack_result, plan_columns, q
from .rowkeys import ROW_KEY, batch_only, keyed_rows

ROW_ID = "monotonic_id"

Detector = Callable[[Column], Column]


def make_detector(recognizers=None, detector: Optional[Detector | Sequence[Detector]] = None) -> Detector:
    """One detector from recognisers, or from one or several given detectors (their spans together)."""
    if detector is None:
        recs = as_recognizers(recognizers)
        return lambda c: detect(c, recs)
    if callable(detector):
        return detector
    return lambda c: concat_spans(*(d(c) for d in detector))


def detect_struct(cols: Sequence[str], recognizers=None, detector: Optional[Detector] = None,
                  row_detector: Optional[Callable] = None) -> Column:
    """Whole-row detection: ``struct<col: spans>`` for the named columns, in order.

    A ``row_detector`` (see ``udf.register_row_detector``) gets all columns in one call.
    """
    if row_detector is not None:
        found = row_detector([q(c) for c in cols])
        return F.element_at(F.transform(F.array(found), lambda a: F.struct(*[a[i].alias(c) for i, c in enumerate(cols)])), 1)
    det = make_detector(recognizers, detector)
    return F.struct(*[det(q(c)).alias(c) for c in cols])


def scan(
    df: DataFrame,
    exclude: Sequence[str] = (),
    known: Sequence[str] = (),
    include: Sequence[str] = ("ALL",),
    recognizers=None,
    detector: Optional[Detector | Sequence[Detector]] = None,
    layout: str = "nested",
    strategy: str = "columns",
    parallelism: Optional[int] = None,
    id_check: bool = False,
    id_debug: bool = False,
    result_col: str = RESULT_COL,
    key: Optional[str] = None,
    strings_only: bool = False,
    row_detector: Optional[Callable] = None,
    language: Optional[str] = None,
    context: Optional[Mapping[str, Context]] = None,
    min_score: float = 0.0,
    chunk: int = CHUNK,
) -> DataFrame:
    """Scan ``df`` and append ``result_col``.

    * ``exclude`` -- never scanned (ids, dates, file metadata ...).
    * ``known`` -- personal on every row: not scanned, flagged ``Full mask``
      and masked whole by :func:`anonymize`.
    * ``detector`` -- in place of the recognisers; several add up.
    * ``row_detector`` -- gets all scanned columns of a row batch in one call.
    * ``layout`` -- ``nested`` (analysis_results + known_pii_columns) or
      ``flat`` (``struct<col: spans>``).
    * ``id_check`` -- scan a copy keyed by ``key`` (or a row id), join back on
      it, and fail unless every row comes back once with its own text (batch only).
    * ``id_debug`` -- keep the row id as a column and in the result.
    * ``strings_only`` -- scan string columns only.
    * ``language`` -- column with the language of each row's texts, for recognisers
      that are limited to some (strategy ``columns``).
    * ``context`` -- words that raise or lower scores nearby (:func:`rescore`), by entity type.
    * ``min_score`` -- spans below it, after that, are left out.
    * ``chunk`` -- strategy ``chunked``: cells of more characters are cut and spread over the tasks.
    """
    plan = plan_columns(df, exclude, known, include, strings_only)
    scored = context is not None or min_score > 0
    if strategy == "chunked":
        if detector is not None or row_detector is not None or language is not None or id_check or id_debug or scored:
            raise ValueError("the chunked strategy goes with plain recognisers")
        return scan_chunked(df, plan, as_recognizers(recognizers), layout, parallelism, result_col, key, chunk)
    plain = make_detector(recognizers, detector)
    det = (lambda c: rescore(c, plain(c), context or {}, min_score)) if scored else plain
    if language is not None and (strategy != "columns" or id_check or detector is not None or row_detector is not None):
        raise ValueError("language goes with recognisers and the plain 'columns' strategy")
    if strategy == "stacked":
        return _scan_stacked(df, plan, det, layout, parallelism, result_col, key)
    if strategy != "columns":
        raise ValueError("strategy must be 'columns', 'stacked' or 'chunked'")
    if id_check:
        return _scan_id_checked(df, plan, det, layout, parallelism, result_col, key)

    base = df
    if id_debug:
        batch_only(df, "id_debug")
        base = df.withColumn(ROW_ID, F.monotonically_increasing_id())
    if parallelism:
        base = base.repartition(parallelism)
    extra = [F.col(ROW_ID).alias(ROW_ID)] if id_debug else []
    cells = [q(c) for c in plan.scanned]
    if detector is not None and row_detector is None or not cells:
        result = pack_result({c: det(q(c)) for c in plan.scanned}, plan.known, layout, extra)
    else:
        found = row_detector(cells) if row_detector is not None else detect_cells(cells, recognizers, q(language) if language else None)
        found = rescore_cells(cells, found, context or {}, min_score) if scored else found
        result = F.element_at(F.transform(F.array(found), lambda a: pack_result(
            {c: a[i] for i, c in enumerate(plan.scanned)}, plan.known, layout, extra)), 1)
    return base.select(*[q(c) for c in base.columns], result.alias(result_col))


def _scan_id_checked(df, plan: ColumnPlan, det, layout, parallelism, result_col, key) -> DataFrame:
    """Scan a copy keyed by a row key and join the result back on it.

    The scanned side carries a hash of the scanned cells and the number of rows with its
    key.  A filter above the left join, which no column pruning removes, fails unless
    each row meets exactly one result with the hash of its own cells.
    """
    batch_only(df, "id_check")
    keyed = keyed_rows(df, key)
    mark = F.xxhash64(*([q(c) for c in plan.scanned] or [F.lit(0)]))
    side = keyed.select(ROW_KEY, *[q(c) for c in plan.scanned])
    if parallelism:
        side = side.repartition(parallelism)
    side = side.select(
        F.col(ROW_KEY), mark.alias("_mark"),
        pack_result({c: det(q(c)) for c in plan.scanned}, plan.known, layout).alias(result_col),
    )
    side = side.groupBy(ROW_KEY).agg(F.count(F.lit(1)).alias("_rows"), F.first("_mark").alias("_mark"), F.first(result_col).alias(result_col))
    joined = keyed.withColumn("_own", mark).join(side, ROW_KEY, "left")
    right = F.coalesce((F.col("_rows") == 1) & (F.col("_mark") == F.col("_own")), F.lit(False))
    checked = joined.where(F.assert_true(right, F.lit("scan result joined to the wrong row")).isNull())
    return checked.select(*[q(c) for c in df.columns], F.col(result_col))


def _scan_stacked(df, plan: ColumnPlan, det, layout, parallelism, result_col, key) -> DataFrame:
    """One row per cell, spread over the tasks; spans regrouped by row key and joined back."""
    batch_only(df, "stacked scan")
    if not plan.scanned:
        return df.select(*[q(c) for c in df.columns], pack_result({}, plan.known, layout).alias(result_col))
    keyed = keyed_rows(df, key)
    cells = keyed.select(ROW_KEY, F.posexplode(F.array(*[q(c).cast("string") for c in plan.scanned])).alias("at", "cell"))
    cells = cells.repartition(parallelism, ROW_KEY, "at") if parallelism else cells.repartition(ROW_KEY, "at")
    found = cells.select(ROW_KEY, "at", det(F.col("cell")).alias("spans"))
    rows = found.groupBy(ROW_KEY).agg(*[
        F.first(F.when(F.col("at") == i, F.col("spans")), ignorenulls=True).cast(SPANS_TYPE).alias(f"_s{i}") for i in range(len(plan.scanned))
    ])
    packed = rows.select(ROW_KEY, pack_result({c: F.col(f"_s{i}") for i, c in enumerate(plan.scanned)}, plan.known, layout).alias(result_col))
    return keyed.join(packed, ROW_KEY).select(*[q(c) for c in df.columns], F.col(result_col))
