"""Schema-driven column choice and result packing.

The scanned set is ``all - exclude - known`` in schema order; names that do
not exist are ignored (like ``DataFrame.drop``).
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.recognizers import FULL_MASK, PII_MASKED
from ..plans.config import parse_list

RESULT_COL = "pii_analysis_result"


def q(name: str) -> Column:
    """Column by exact name (dots or spaces in the name are fine)."""
    return F.col(f"`{name.replace('`', '``')}`")


@dataclass(frozen=True)
class ColumnPlan:
    scanned: list
    excluded: list
    known: list


def plan_columns(df: DataFrame, exclude=(), known=(), include=("ALL",), strings_only: bool = False) -> ColumnPlan:
    """Which columns are scanned: of ``include`` (``ALL``: every column) those not in ``exclude``,
    not in ``known`` and, with ``strings_only``, of string type; in schema order."""
    names = df.columns
    excl = set(parse_list(exclude))
    known_l = parse_list(known)
    missing = [k for k in known_l if k not in names]
    if missing:
        warnings.warn(f"known PII columns not in table, ignored: {missing}")
    known_l = [k for k in known_l if k in names]
    wanted = set(parse_list(include))
    everything = "ALL" in wanted
    types = {f.name: f.dataType for f in df.schema.fields}
    scanned = [
        c for c in names
        if (everything or c in wanted) and c not in excl and c not in known_l and c != RESULT_COL
        and (not strings_only or isinstance(types[c], T.StringType))
    ]
    return ColumnPlan(scanned=scanned, excluded=[c for c in names if c in excl], known=known_l)


def pack_result(span_cols: dict, known: Sequence[str], layout: str = "nested", extra: Sequence[Column] = ()) -> Column:
    """Build the result struct from ``{column: spans Column}``.

    nested: ``struct<analysis_results: struct<col: spans>, known_pii_columns:
    struct<col: 'Full mask'>>``; a member with no fields is left out, since
    Parquet cannot store an empty struct.  flat: ``struct<col: spans>``.
    """
    analysed = [c.alias(name) for name, c in span_cols.items()]
    if layout == "flat":
        return F.struct(*analysed, *extra)
    if layout != "nested":
        raise ValueError("layout must be 'nested' or 'flat'")
    members = []
    if analysed:
        members.append(F.struct(*analysed).alias("analysis_results"))
    if known:
        members.append(F.struct(*[F.lit(FULL_MASK).alias(k) for k in known]).alias("known_pii_columns"))
    if not members:
        raise ValueError("nothing to scan and no known PII columns")
    return F.struct(*members, *extra)


def result_columns(df: DataFrame, result_col: str = RESULT_COL) -> tuple[list, list]:
    """(analysed columns, known columns) read back from the result type.

    Accepts the nested layout and the flat one (flat has no known list).
    """
    rtype = df.schema[result_col].dataType
    names = rtype.fieldNames()
    if "analysis_results" in names or "known_pii_columns" in names:
        analysed = rtype["analysis_results"].dataType.fieldNames() if "analysis_results" in names else []
        known = rtype["known_pii_columns"].dataType.fieldNames() if "known_pii_columns" in names else []
        return analysed, known
    return names, []


def spans_col(df: DataFrame, column: str, result_col: str = RESULT_COL) -> Column:
    """The spans of ``column`` inside the result struct, for either layout."""
    rtype = df.schema[result_col].dataType
    base = F.col(result_col)
    if "analysis_results" in rtype.fieldNames():
        base = base.getField("analysis_results")
    return base.getField(column)


def full_mask(df: DataFrame, known: Sequence[str], token: str = PII_MASKED, mask_nulls: bool = True) -> DataFrame:
    """Replace whole columns by ``token``; column order kept.

    Constant folding means a masked source column is not even read.
    With ``mask_nulls=False`` a null cell stays null.
    """
    known_set = set(known)

    def m(c):
        if c not in known_set:
            return q(c)
        if mask_nulls:
            return F.lit(token).alias(c)
        return F.when(q(c).isNull(), F.lit(None).cast("string")).otherwise(F.lit(token)).alias(c)

    return df.select(*[m(c) for c in df.columns])
