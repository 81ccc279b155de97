"""Samples that are the same rows on every run, and that merge.

A row's place in the sample is the md5 of its key, so the sample of a table is its ``k`` rows with the smallest
digests, however the table is partitioned.  Samples merge: the k smallest of two samples are the sample of both tables.

Only about k rows leave the scan.  Digests are uniform, so a bound that k and six standard deviations more rows fall under
is known from the row count; rows above it are filtered where they are read, and the few below it are ordered.
In the rare case that fewer than k rows pass, the bound is widened and the scan repeated.
"""

from __future__ import annotations

import math
from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import q

DIGEST = "sample_digest"
#: Hexadecimal digits of the digest that are compared with the bound as a number.
_DIGITS = 15


def sample_digest(key: Column) -> Column:
    """md5 of the key as text; a null key counts as the empty text."""
    return F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def _bound(rows: int, wanted: int) -> Optional[str]:
    """Digests (their first digits) under which about ``wanted`` of ``rows`` rows fall, None: all."""
    part = wanted / rows
    return None if part >= 1 else format(math.ceil(part * 16 ** _DIGITS), f"0{_DIGITS}x")


def bottom_k(df: DataFrame, key: str, k: int, after: Optional[str] = None, rows: Optional[int] = None) -> DataFrame:
    """The ``k`` rows of ``df`` with the smallest md5 of ``key`` (all, if there are fewer), with that digest in ``sample_digest``.

    ``after`` leaves out digests up to that one, so a sample is extended without reading the first rows
    again.  ``rows`` is the number of rows of ``df`` if the caller knows it.  ``key`` should tell rows apart; of rows
    with one key the first by their own digest are taken.
    """
    if k < 1:
        raise ValueError("a sample has at least one row")
    total = df.count() if rows is None else rows
    marked = df.withColumn(DIGEST, sample_digest(q(key)))
    seen = 0.0
    if after is not None:
        marked = marked.where(F.col(DIGEST) > after)
        seen = int(after[:_DIGITS], 16) / 16 ** _DIGITS
    wanted = k + 6 * math.sqrt(k) + 16 + seen * total
    while True:
        bound = _bound(total, wanted) if total else None
        below = marked if bound is None else marked.where(F.col(DIGEST) < bound)
        if bound is None or below.limit(k).count() == k:
            return below.orderBy(DIGEST, _own(below)).limit(k)
        wanted *= 4


def _own(rows: DataFrame) -> Column:
    """Digest of a row: it makes the choice among rows of one key repeatable."""
    return F.md5(F.to_json(F.struct(*[q(c) for c in rows.columns if c != DIGEST])).cast("binary"))


def merge_samples(a: DataFrame, b: DataFrame, k: int) -> DataFrame:
    """The sample of two tables from a sample of each (with its ``sample_digest``)."""
    both = a.unionByName(b)
    return both.orderBy(DIGEST, _own(both)).limit(k)
