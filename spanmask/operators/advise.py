"""Which columns to scan, to leave out, or to mask whole: a column plan from evidence.

String columns are scanned on a growing sample.  After each round the share of cells with personal data, and the
share of cells that are personal from end to end, have Wilson bounds; a column is decided as soon
as the bounds are on one side of the limits, and only undecided columns go into the next round.  Rounds take the next rows of
one nested sample (:mod:`.sample`), so no row is scanned twice and the advice is the same on every run.  A table
that is read to its end decides by its exact shares.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.spans import as_recognizers, detect, resolve_spans
from .columns import q
from .sample import DIGEST, bottom_k

#: At most this share of cells with personal data: the column may be left out of the scan.
LOW = 0.01
#: At least this share of cells that are personal from end to end: the column is masked whole.
HIGH = 0.95
#: Normal quantile of the bounds (two-sided 99 %).
Z = 2.576
FIRST, GROWTH = 512, 4

ADVICE_TYPE = T.StructType([
    T.StructField("column", T.StringType()), T.StructField("advice", T.StringType()), T.StructField("sampled", T.LongType()),
    T.StructField("filled", T.LongType()), T.StructField("hits", T.LongType()), T.StructField("whole", T.LongType()),
    T.StructField("hit_low", T.DoubleType()), T.StructField("hit_high", T.DoubleType()),
    T.StructField("whole_low", T.DoubleType()), T.StructField("whole_high", T.DoubleType()),
])


def wilson(hits: int, n: int, z: float = Z) -> tuple[float, float]:
    """Bounds of a share of which ``hits`` of ``n`` are seen; without any, nothing is known."""
    if n == 0:
        return 0.0, 1.0
    p, zz = hits / n, z * z / n
    middle, half = p + zz / 2, z * math.sqrt(p * (1 - p) / n + zz / (4 * n))
    return max(0.0, (middle - half) / (1 + zz)), min(1.0, (middle + half) / (1 + zz))


@dataclass
class Evidence:
    """What is known of a column: cells that are not blank, those with a hit, those that are hits from end to end."""

    filled: int = 0
    hits: int = 0
    whole: int = 0

    def add(self, filled: int, hits: int, whole: int) -> None:
        self.filled, self.hits, self.whole = self.filled + filled, self.hits + hits, self.whole + whole

    def advice(self, finished: bool, low: float, high: float, z: float) -> Optional[str]:
        """``known``, ``exclude`` or ``scan``; None: not decided yet."""
        if finished:
            if self.filled and self.whole >= high * self.filled:
                return "known"
            return "exclude" if self.hits <= low * self.filled else "scan"
        hit_low, hit_high = wilson(self.hits, self.filled, z)
        whole_low, whole_high = wilson(self.whole, self.filled, z)
        if whole_low >= high:
            return "known"
        if hit_high <= low:
            return "exclude"
        return "scan" if hit_low > low and whole_high < high else None


def _counts(rows: DataFrame, columns: Sequence[str], recognizers) -> tuple[dict[str, tuple[int, int, int]], Optional[str]]:
    """(filled, hits, whole) of each column and the last digest, in one aggregate."""
    found = rows.select(DIGEST, *[
        F.struct(
            (F.length(F.trim(q(c))) > 0).alias("filled"),
            resolve_spans(detect(q(c), recognizers)).alias("spans"), F.length(F.trim(q(c))).alias("n"),
        ).alias(f"_c{i}") for i, c in enumerate(columns)
    ])
    covered = lambda i: F.aggregate(F.col(f"_c{i}.spans"), F.lit(0), lambda a, s: a + s["end"] - s["start"])
    aggregates = [F.max(DIGEST).alias("last")]
    for i in range(len(columns)):
        filled = F.coalesce(F.col(f"_c{i}.filled"), F.lit(False))
        hit = F.size(F.col(f"_c{i}.spans")) > 0
        aggregates += [F.count_if(filled).alias(f"f{i}"), F.count_if(filled & hit).alias(f"h{i}"), F.count_if(filled & hit & (covered(i) >= F.col(f"_c{i}.n"))).alias(f"w{i}")]
    r = found.agg(*aggregates).first()
    return {c: (r[f"f{i}"], r[f"h{i}"], r[f"w{i}"]) for i, c in enumerate(columns)}, r["last"]


def advise_columns(
    df: DataFrame, key: str, columns: Optional[Sequence[str]] = None, recognizers=None, low: float = LOW, high: float = HIGH,
    z: float = Z, first: int = FIRST, growth: int = GROWTH,
) -> DataFrame:
    """One row per string column of ``df`` but ``key`` (or per given column): the advice, the rows sampled and what it rests on.

    ``exclude``: personal data in at most ``low`` of the cells that are not blank; ``known``: at least ``high`` of them are
    personal from end to end; else ``scan``.  ``key`` must tell rows apart.  A sample of ``first`` rows grows by
    ``growth`` until every column is decided.  What reaches the driver is three counts per column and round.  A table without rows, and a
    column of blanks, give ``exclude``.  The lists go to ``scan`` as they are (see :func:`plan_from`).
    """
    if not 0 < low < high < 1 or first < 1 or growth < 2:
        raise ValueError("needs 0 < low < high < 1, a first sample and a growth of at least 2")
    recs = as_recognizers(recognizers)
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != key] if columns is None else list(columns)
    kept = df.select(q(key).alias(key), *[q(c).cast("string").alias(c) for c in names if c != key])
    total = kept.count()
    open_, decided = {c: Evidence() for c in names}, {}
    sampled, after = 0, None
    while open_:
        want = min(total, first if not sampled else sampled * growth)
        if want > sampled:
            rows = bottom_k(kept.select(key, *[q(c) for c in open_ if c != key]), key, want - sampled, after, total)
            rows = rows.repartition(min(want - sampled, 4 * df.sparkSession.sparkContext.defaultParallelism))  # ordered rows are one partition
            counts, after = _counts(rows, list(open_), recs)
            for c, found in counts.items():
                open_[c].add(*found)
            sampled = want
        for c in list(open_):
            advice = open_[c].advice(sampled >= total, low, high, z)
            if advice:
                decided[c] = (advice, sampled, open_.pop(c))
    out = []
    for c in names:
        advice, n, e = decided[c]
        out.append((c, advice, n, e.filled, e.hits, e.whole, *wilson(e.hits, e.filled, z), *wilson(e.whole, e.filled, z)))
    return df.sparkSession.createDataFrame(out, ADVICE_TYPE)


def plan_from(advice: DataFrame) -> dict[str, list[str]]:
    """``exclude`` and ``known`` lists for :func:`scan`."""
    rows = advice.select("column", "advice").collect()
    return {kind: [r["column"] for r in rows if r["advice"] == kind] for kind in ("exclude", "known")}
