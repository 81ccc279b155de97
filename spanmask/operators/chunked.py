"""Scan of very long cells: cut, spread over the tasks, stitched.

A cell is one value of one row, so the plain scan reads a cell of a gigabyte in one task.  Here a cell of more than
``chunk`` characters becomes rows of about that many, which a shuffle deals out one by one; only spans come back.

*Seams.*  Spans of a cut text equal those of the whole one only if no match, and nothing a match depends on, lies across a cut.
Every recogniser names the characters that its matches can hold (``alphabet``).  A seam is moved from the
nominal place, a multiple of ``chunk``, to just after the first character that no alphabet holds and that is no
combining mark (a word boundary looks through these).  The piece behind the seam is scanned with that character in front of it, so a
look-around of one character sees what it sees in the whole text.  Where a chunk holds no such character the seam is left out and
the pieces on both sides stay one: right for every text, at the price of one longer piece (a cell that is one run of
hexadecimal digits stays whole).

*Cost.*  Rows without a long cell are scanned in place, as in the plain strategy; only rows with one are keyed, cut
and joined.  A cell is cut once from front to back, offsets are multiples of ``chunk`` plus the length moved, so cutting is
linear in the text.  All spans of a cell end in one array of its row, as in every scan.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recognizers import Recognizer
from ..functions.spans import NO_SPANS, SPANS_TYPE, detect, detect_cells, sort_spans
from ..functions.sqltext import apply, let, lit
from .columns import ColumnPlan, pack_result, q
from .rowkeys import ROW_KEY, batch_only, keyed_rows

#: Characters of a cell from which on it is cut, and of a chunk.
CHUNK = 1 << 18


@lru_cache(maxsize=32)
def _pieces_sql(alphabets: tuple, chunk: int) -> str:
    """array<struct<from, lead, text>> of a text ``t``: offset of the piece, characters in front of it that are not its own, its text."""
    held = "".join(f"[{a}]" for a in alphabets)          # a class within a class is a union
    heads = f"transform(c, x -> regexp_extract(x, {lit(rf'^[{held}\p{{M}}]*+[^{held}\p{{M}}]')}, 0))"
    first = "filter(sequence(0, size(c) - 1), i -> i = 0 or length(h[i]) > 0)"
    until = "if(j + 1 < size(f), f[j + 1], size(c))"
    body = "concat(if(i = 0, c[0], concat(right(h[i], 1), substr(c[i], length(h[i]) + 1))), array_join(slice(c, i + 2, n - i - 1), ''), if(n < size(c), h[n], ''))"
    start = f"if(i = 0, 0L, cast(i as bigint) * {chunk} + length(h[i]))"
    piece = let("n", until, f"named_struct('from', {start}, 'lead', if(i = 0, 0, 1), 'text', {body})")
    cut = let("h", heads, let("f", first, f"transform(f, (i, j) -> {piece})"))
    return let("c", f"regexp_extract_all(t, {lit(f'(?s).{{1,{chunk}}}')}, 0)", f"if(size(c) = 0, array(named_struct('from', 0L, 'lead', 0, 'text', t)), {cut})")


def text_pieces(text: Column, recognizers: Sequence[Recognizer], chunk: int = CHUNK) -> Column:
    """A text as pieces that can be scanned apart: ``array<struct<from,lead,text>>``, in order.

    Without their ``lead`` the pieces put together are the text.  Empty for a null text.
    """
    if chunk < 1:
        raise ValueError("a chunk has one character or more")
    unknown = [r.entity_type for r in recognizers if not r.alphabet]
    if unknown:
        raise ValueError(f"a long text cannot be cut for {', '.join(unknown)}: name the characters of a match (alphabet)")
    held = tuple(sorted({r.alphabet for r in recognizers})) or ("a",)
    return F.coalesce(apply(text.cast("string"), _pieces_sql(held, int(chunk))), F.array().cast("array<struct<`from`:bigint,lead:int,text:string>>"))


def scan_chunked(df: DataFrame, plan: ColumnPlan, recognizers: Sequence[Recognizer], layout: str, parallelism: Optional[int],
                 result_col: str, key: Optional[str], chunk: int = CHUNK) -> DataFrame:
    """:func:`scan` with long cells cut into pieces; the same rows and spans, in any row order.

    ``df`` is read twice, once for the rows without a long cell and once for those with one.  ``key`` must be unique among the latter;
    without one these rows are written with a row id.  ``parallelism`` is the number of tasks that scan pieces.
    """
    batch_only(df, "chunked scan")
    cells = [q(c).cast("string") for c in plan.scanned]
    pack = lambda found: F.element_at(F.transform(F.array(found), lambda a: pack_result(
        {c: a[i] for i, c in enumerate(plan.scanned)}, plan.known, layout)), 1).alias(result_col)
    own = [q(c) for c in df.columns]
    if not cells:
        return df.select(*own, pack_result({}, plan.known, layout).alias(result_col))
    long = reduce(lambda a, b: a | b, [F.coalesce(F.length(c) > chunk, F.lit(False)) for c in cells])
    short = df.where(~long).select(*own, pack(detect_cells(cells, recognizers)))

    keyed = keyed_rows(df.where(long), key)
    texts = keyed.select(ROW_KEY, F.posexplode(F.array(*[text_pieces(c, recognizers, chunk) for c in cells])).alias("_at", "_pieces"))
    pieces = texts.select(ROW_KEY, "_at", F.inline("_pieces").alias("_from", "_lead", "_text"))
    deal = [ROW_KEY, "_at", "_from"]
    pieces = pieces.repartition(parallelism, *deal) if parallelism else pieces.repartition(*deal)
    shift = F.col("_from") - F.col("_lead")
    found = pieces.select(ROW_KEY, "_at", F.transform(detect(F.col("_text"), recognizers), lambda s: F.struct(
        s["entity_type"].alias("entity_type"), (s["start"] + shift).cast("int").alias("start"), (s["end"] + shift).cast("int").alias("end"),
        s["score"].alias("score"))).alias("_spans"))
    # The outer form: a plain explode brings a filter on the spans, which Spark would evaluate ahead of the shuffle.
    spans = found.select(ROW_KEY, "_at", F.explode_outer("_spans").alias("_span"))
    rows = spans.groupBy(ROW_KEY).agg(*[F.collect_list(F.when(F.col("_at") == i, F.col("_span"))).alias(f"_s{i}") for i in range(len(cells))])
    none = F.expr(NO_SPANS)
    stitched = F.array(*[sort_spans(F.coalesce(F.col(f"_s{i}"), none).cast(SPANS_TYPE)) for i in range(len(cells))])
    cut = keyed.join(rows, ROW_KEY, "left").select(*own, pack(stitched))
    return short.unionByName(cut)
