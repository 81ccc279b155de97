"""Span columns: detection, overlap resolution, long form.

Everything here returns a ``Column`` built from Spark built-ins, so a scan
is one narrow projection that runs inside the JVM next to the parquet
reader, with no Python worker and no shuffle.

Offsets are 0-based code points, ``start`` inclusive and ``end``
exclusive, so ``substring(text, start + 1, end - start)`` is the hit.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .recognizers import Recognizer, get_recognizers
from .sqltext import apply, let, lit

SPAN_TYPE = T.StructType(
    [
        T.StructField("entity_type", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
    ]
)
SPANS_TYPE = T.ArrayType(SPAN_TYPE)

_FIELDS = "entity_type: string, `start`: int, `end`: int, score: double"
NO_SPANS = f"cast(array() as array<struct<{_FIELDS}>>)"
# Spans plus the matched text, used while validating.
_NO_HITS = f"cast(array() as array<struct<{_FIELDS}, `text`: string>>)"


def _empty(dtype: T.DataType) -> Column:
    return F.array().cast(T.ArrayType(dtype))


def prefix_scan_sql(array: str, step: str, zero: str = "0", block: int = 64) -> str:
    """Inclusive prefix scan of an int array; ``step`` combines ``s`` and ``x``.

    A fold that appends to an array copies it at every step, O(k^2) for a
    cell with k hits.  Here the array is cut into blocks: totals of the blocks,
    an exclusive fold over the k/block totals, then each element adds its
    in-block prefix.  Cost O(block * k + (k / block)^2 / 2) array cells copied.
    """
    at = f"cast(i div {block} as int)"
    combine = lambda a, b: step.replace("{s}", a).replace("{x}", b)
    totals = f"transform(sequence(0, cast((size(a) - 1) div {block} as int)), b -> aggregate(slice(a, b * {block} + 1, {block}), {zero}, (s, x) -> {combine('s', 'x')}))"
    before = (
        f"aggregate(totals, named_struct('run', {zero}, 'out', cast(array() as array<int>)), "
        f"(acc, x) -> named_struct('run', {combine('acc.run', 'x')}, 'out', array_append(acc.out, acc.run)), acc -> acc.out)"
    )
    inside = f"aggregate(slice(a, {at} * {block} + 1, i - {at} * {block} + 1), {zero}, (s, y) -> {combine('s', 'y')})"
    each = f"transform(a, (x, i) -> {combine(f'before[{at}]', inside)})"
    return let("a", array, f"if(size(a) = 0, a, {let('totals', totals, let('before', before, each))})")


SUM, LATEST = "{s} + {x}", "greatest({s}, {x})"


def _hits_sql(rec: Recognizer) -> str:
    """array<span + text> of every non-overlapping match of one pattern in ``t``.

    ``regexp_extract_all`` gives the matches and ``split(.., -1)`` the
    pieces between them (both walk the same ``Matcher.find`` sequence).
    Interleaving their lengths (piece 0, match 0, piece 1, ...) and taking
    prefix sums gives every match's start and end.  The split runs only
    for cells with a match, and the regex not at all for cells lacking the
    hint.  A null ``t`` has no match.
    """
    pattern = lit(rec.java or rec.pattern)
    lengths = "flatten(transform(m, (x, i) -> array(length(p[i]), length(x))))"
    hits = (
        f"transform(m, (x, i) -> named_struct('entity_type', {lit(rec.entity_type)}, 'start', sums[2 * i], "
        f"'end', sums[2 * i + 1], 'score', {float(rec.score)!r}D, 'text', x))"
    )
    if rec.validator:
        hits = f"filter({hits}, h -> {rec.validator}(h.text))"
    found = let("p", f"split(t, {pattern}, -1)", let("sums", prefix_scan_sql(lengths, SUM), hits))
    found = let("m", f"regexp_extract_all(t, {pattern}, 0)", f"if(size(m) > 0, {found}, {_NO_HITS})")
    return f"if(instr(t, {lit(rec.hint)}) > 0, {found}, {_NO_HITS})" if rec.hint else found


def _sorted_sql(spans: str) -> str:
    """Order by (start, end desc, entity_type): the natural order of a key struct, no comparator."""
    keyed = f"transform({spans}, x -> named_struct('a', x.`start`, 'b', -x.`end`, 'c', x.entity_type, 'x', x))"
    return f"transform(array_sort({keyed}), k -> k.x)"


def _spoken_sql(rec: Recognizer) -> str:
    """The hits of one recogniser in a text ``t`` of language ``lang``."""
    if not rec.languages:
        return _hits_sql(rec)
    return f"if(lang in ({', '.join(map(lit, rec.languages))}), {_hits_sql(rec)}, {_NO_HITS})"


@lru_cache(maxsize=256)
def _detect_sql(recognizers: tuple, texts: bool, spoken: bool = False) -> str:
    if not recognizers:
        return _NO_HITS if texts else NO_SPANS
    hits = _sorted_sql(f"concat({', '.join(map(_spoken_sql if spoken else _hits_sql, recognizers))})")
    if texts:
        return hits
    return f"transform({hits}, h -> named_struct('entity_type', h.entity_type, 'start', h.`start`, 'end', h.`end`, 'score', h.score))"


def detect_hits(text: Column, recognizers: Sequence[Recognizer]) -> Column:
    """Like :func:`detect` but each span keeps the matched ``text``."""
    return apply(text.cast("string"), _detect_sql(tuple(recognizers), True))


def detect(text: Column, recognizers=None) -> Column:
    """``array<struct<entity_type,start,end,score>>`` of every hit in ``text``.

    ``text`` is cast to string; a null cell gives an empty array.  Spans are
    ordered by (start, end desc, entity_type).  Overlaps between entities
    are kept; :func:`resolve_spans` merges them before rewriting.
    """
    return apply(text.cast("string"), _detect_sql(tuple(as_recognizers(recognizers)), False)).cast(SPANS_TYPE)


def detect_cells(texts: Sequence[Column], recognizers=None, language: Column = None) -> Column:
    """:func:`detect` of several columns as one array: a wide table costs one span expression, not one per column.

    With ``language`` (of the row), recognisers that name languages look at texts of those only.
    """
    body = _detect_sql(tuple(as_recognizers(recognizers)), False, language is not None)
    cells = F.array(*[t.cast("string") for t in texts])
    if language is None:
        found = apply(cells, f"transform(cells, t -> {body})", "cells")
    else:
        row = F.struct(cells.alias("cells"), language.cast("string").alias("lang"))
        found = apply(row, let("lang", "row.lang", f"transform(row.cells, t -> {body})"), "row")
    return found.cast(T.ArrayType(SPANS_TYPE))


def sort_spans(spans: Column) -> Column:
    """Order spans by (start asc, end desc, entity_type asc)."""
    return apply(spans, _sorted_sql("t"))


@lru_cache(maxsize=8)
def resolve_sql(spans: str) -> str:
    """The islands of an array of spans; see :func:`resolve_spans`."""
    heads = "filter(sequence(0, size(s) - 1), i -> i = 0 or s[i].`start` >= ends[greatest(i - 1, 0)])"
    island = let("nxt", "if(j + 1 < size(heads), heads[j + 1], size(s))", let(
        "best", "aggregate(slice(s, head + 1, nxt - head), s[head], (b, x) -> if(x.score > b.score, x, b))",
        "named_struct('entity_type', best.entity_type, 'start', s[head].`start`, 'end', ends[nxt - 1], 'score', best.score)",
    ))
    islands = let("ends", prefix_scan_sql("transform(s, x -> x.`end`)", LATEST), let("heads", heads, f"transform(heads, (head, j) -> {island})"))
    return let("s", _sorted_sql(f"coalesce({spans}, {NO_SPANS})"), f"if(size(s) = 0, {NO_SPANS}, {islands})")


def resolve_spans(spans: Column) -> Column:
    """Merge overlapping spans into islands.

    Sorted by (start, end desc, entity_type), a span whose start lies
    before the running island end joins the island; the island keeps the
    label and score of its highest-scoring member (ties: first in sort
    order).  Touching spans stay apart.  A null array counts as empty.

    The running end is a prefix max; island heads are the spans starting
    at or after the running end of all earlier spans; each island's label
    comes from one pass over its own members.
    """
    return apply(spans.cast(SPANS_TYPE), resolve_sql("t")).cast(SPANS_TYPE)


def as_recognizers(recognizers) -> list[Recognizer]:
    """Accept recogniser objects, entity names, ``"ALL"`` or None (defaults)."""
    if recognizers is not None and not isinstance(recognizers, str) \
            and all(isinstance(r, Recognizer) for r in recognizers):
        return list(recognizers)
    return get_recognizers(recognizers)


def concat_spans(*arrays: Column) -> Column:
    """Union of several span arrays (e.g. patterns + gazetteer), re-sorted."""
    arrs = [F.coalesce(a, _empty(SPAN_TYPE)).cast(SPANS_TYPE) for a in arrays]
    return sort_spans(reduce(lambda a, b: F.concat(a, b), arrs))
