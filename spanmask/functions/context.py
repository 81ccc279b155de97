"""Scores from context: words near a hit make it more or less likely.

A run of digits after "card" is a card number; after "order" it hardly is.  A :class:`Context`
names such words for one entity, and :func:`rescore` moves the scores of that entity's spans before
overlaps are resolved, because an island takes the label of its surest span.

Words are runs of letters.  Near means among the ``window`` last words that end at or before the start of a span, or
among the ``window`` first words that begin at or after its end; a word that runs into the span is neither.  Texts are
compared in lower case.

Inside a cell this is a merge of two sorted lists of positions, words and spans: a span that stands at place i of the
merged list and is the k-th span has i - k words before it.  A running count of the context words then answers each
band with two lookups, so a cell costs n log n in words and spans, whatever the window.  Cells without a span of
an entity that has a context are left alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from typing import Mapping, Optional

from pyspark.sql import Column
from pyspark.sql import functions as F

from .spans import NO_SPANS, SPANS_TYPE, SUM, _sorted_sql, prefix_scan_sql
from .sqltext import apply, let, lit


@dataclass(frozen=True)
class Context:
    """Words that raise or lower the score of an entity nearby, and by how much.

    A span with words of both kinds nearby gets both changes.  Scores stay between 0 and 1.
    """

    raises: tuple[str, ...] = ()
    lowers: tuple[str, ...] = ()
    raise_by: float = 0.35
    lower_by: float = 0.35
    window: int = 5

    def __post_init__(self):
        for word in (*self.raises, *self.lowers):
            if not re.fullmatch(r"[^\W\d_]+", word) or word != word.lower():
                raise ValueError(f"a context word is one run of lower-case letters, not {word!r}")
        if self.window < 1 or min(self.raise_by, self.lower_by) < 0:
            raise ValueError("a context needs a window of one word or more, and changes that are not negative")


# --- fixed values --------------------------------------------------------
# Context words of the built-in entities (our own choice).
CONTEXTS = {
    "EMAIL_ADDRESS": Context(("contact", "email", "mail", "write"), ("example", "noreply")),
    "IP_ADDRESS": Context(("address", "gateway", "host", "ip", "server"), ("release", "section", "version")),
    "CREDIT_CARD": Context(("amex", "card", "credit", "debit", "mastercard", "visa"), ("invoice", "isbn", "order", "serial")),
    "PHONE_NUMBER": Context(("call", "cell", "mobile", "phone", "tel", "telephone"), ("fax",)),
    "SECRET_TOKEN": Context(("key", "password", "secret", "token"), ("checksum", "commit", "digest", "sha")),
}
# -------------------------------------------------------------------------

_WORD = lit(r"\p{L}+")


def _words_before(words: str) -> str:
    """Words that end at or before the start of each span of ``s`` (sorted by start)."""
    marks = f"concat(transform({words}, x -> named_struct('at', x.e, 'span', false)), transform(s, x -> named_struct('at', x.`start`, 'span', true)))"
    places = f"filter(transform(array_sort({marks}), (x, i) -> if(x.span, i, -1)), i -> i >= 0)"
    return f"transform({places}, (i, k) -> i - k)"


def _words_up_to(words: str) -> str:
    """Words that begin before the end of each span of ``s``, in the order of ``s``."""
    marks = (f"concat(transform({words}, x -> named_struct('at', x.b, 'word', true, 'j', -1)), "
             "transform(s, (x, j) -> named_struct('at', x.`end`, 'word', false, 'j', j)))")
    places = f"filter(transform(array_sort({marks}), (x, i) -> named_struct('j', x.j, 'i', i)), y -> y.j >= 0)"
    return f"transform(array_sort(transform({places}, (y, k) -> named_struct('j', y.j, 'n', y.i - k))), y -> y.n)"


def _near(counts: str, window: int) -> str:
    """Whether a band around the span with ``nb`` words before it and ``na`` up to its end holds a counted word."""
    upto = lambda i: f"if({i} > 0, {counts}[{i} - 1], 0)"
    low, high = f"greatest(nb[j] - {window}, 0)", f"least(na[j] + {window}, size({counts}))"
    return f"({upto('nb[j]')} > {upto(low)} or {upto(high)} > {upto('na[j]')})"


@lru_cache(maxsize=64)
def _rescore_sql(contexts: tuple, min_score: float) -> str:
    entities = f"in ({', '.join(lit(e) for e, _ in contexts)})"
    score, counts = "x.score", []
    for entity, c in contexts:
        changes = []
        for listed, by in ((c.raises, f"{float(c.raise_by)!r}D"), (c.lowers, f"-{float(c.lower_by)!r}D")):
            if listed:
                flags = f"transform(w, z -> if(z.t in ({', '.join(map(lit, listed))}), 1, 0))"
                counts.append(f"if(exists(s, x -> x.entity_type = {lit(entity)}), {prefix_scan_sql(flags, SUM)}, cast(array() as array<int>))")
                changes.append(f"if({_near(f'counts[{len(counts) - 1}]', c.window)}, {by}, 0D)")
        if changes:
            new = f"round(greatest(0D, least(1D, x.score + {' + '.join(changes)})), 6)"
            score = f"if(x.entity_type = {lit(entity)}, {new}, {score})"
    moved = f"transform(s, (x, j) -> named_struct('entity_type', x.entity_type, 'start', x.`start`, 'end', x.`end`, 'score', {score}))"
    moved = let("nb", _words_before("w"), let("na", _words_up_to("w"), let("counts", f"array({', '.join(counts)})", moved)))
    lengths = "flatten(transform(m, (x, i) -> array(length(p[i]), length(x))))"
    words = "transform(m, (x, i) -> named_struct('t', lower(x), 'b', sums[2 * i], 'e', sums[2 * i + 1]))"
    words = let("m", f"regexp_extract_all(row.t, {_WORD}, 0)", let("p", f"split(row.t, {_WORD}, -1)", let("sums", prefix_scan_sql(lengths, SUM), words)))
    body = let("s", _sorted_sql(f"coalesce(row.s, {NO_SPANS})"), f"if(exists(s, x -> x.entity_type {entities}), {let('w', words, moved)}, s)" if contexts else "s")
    return f"filter({body}, x -> x.score >= {float(min_score)!r}D)" if min_score > 0 else body


def rescore(text: Column, spans: Column, contexts: Optional[Mapping[str, Context]] = None, min_score: float = 0.0) -> Column:
    """``spans`` of ``text`` with scores moved by the words around them; spans below ``min_score`` are left out.

    ``contexts`` maps entity types to their :class:`Context` (none given: :data:`CONTEXTS`).  Spans are sorted by
    (start, end desc, entity_type).  A null text or null spans give an empty array.  Spans may come from any
    detector.
    """
    chosen = CONTEXTS if contexts is None else contexts
    row = F.struct(F.coalesce(text.cast("string"), F.lit("")).alias("t"), spans.cast(SPANS_TYPE).alias("s"))
    return apply(row, _rescore_sql(tuple(sorted(chosen.items())), float(min_score)), "row").cast(SPANS_TYPE)


def rescore_cells(texts, found: Column, contexts: Optional[Mapping[str, Context]] = None, min_score: float = 0.0) -> Column:
    """:func:`rescore` of several columns and the array of their span arrays, as one expression."""
    chosen = CONTEXTS if contexts is None else contexts
    body = _rescore_sql(tuple(sorted(chosen.items())), float(min_score))
    rows = F.arrays_zip(F.array(*[F.coalesce(t.cast("string"), F.lit("")) for t in texts]).alias("t"), found.alias("s"))
    return apply(rows, f"transform(rows, r -> {let('row', "named_struct('t', r.t, 's', r.s)", body)})", "rows")
