"""Rewrite the flagged parts of a text cell; every other character stays."""

from __future__ import annotations

from functools import lru_cache
from typing import Mapping, Optional, Sequence, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

from .pseudonym import pseudonym_sql
from .spans import NO_SPANS, SPANS_TYPE, resolve_sql
from .sqltext import apply, let, lit

# Operator names accepted per entity type.
#   replace  -> "<ENTITY_TYPE>" (or the given text)
#   redact   -> ""
#   mask     -> Spark mask(): upper X, lower x, digit n, others kept
#   hash     -> sha2(hit, 256), hex
#   keep     -> the hit itself
#   pseudonym, with a key -> other digits and letters in the same format
#   restore, with the key -> the value behind such a pseudonym
OPERATORS = ("replace", "redact", "mask", "hash", "keep", "pseudonym", "restore")

OperatorSpec = Union[str, tuple]


def _apply(op: OperatorSpec) -> str:
    """SQL of one operator on ``hit``, the matched text of span ``x``."""
    name, arg = (op, None) if isinstance(op, str) else (op[0], op[1])
    if name == "replace":
        return lit(arg) if arg is not None else "concat('<', x.entity_type, '>')"
    if name == "redact":
        return "''"
    if name == "mask":
        return "mask(hit)"
    if name == "hash":
        return "sha2(hit, 256)"
    if name == "keep":
        return "hit"
    if name in ("pseudonym", "restore"):
        if not arg:
            raise ValueError(f"operator {name!r} needs a key: ({name!r}, key)")
        return pseudonym_sql(arg, inverse=name == "restore")
    raise ValueError(f"unknown operator {name!r}; choose from {OPERATORS}")


#: Characters of a text that are cut off together.  A substring of a text with multi-byte characters is looked for
#: from its start; one of a few chunks is not, so a rewrite is linear in the text and its hits.
CHUNK = 256


def _part(start: str, end: str) -> str:
    """Characters ``start`` to ``end`` of the text, from its chunks."""
    low = f"cast(at.a div {CHUNK} as int)"
    some = f"slice(chunks, {low} + 1, cast((at.b - 1) div {CHUNK} as int) - {low} + 1)"
    return let("at", f"named_struct('a', {start}, 'b', {end})", f"if(at.b <= at.a, '', substring(array_join({some}, ''), at.a - {low} * {CHUNK} + 1, at.b - at.a))")


@lru_cache(maxsize=64)
def _rewrite_sql(operators: tuple, default: OperatorSpec, resolve: bool) -> str:
    """Per span (gap before it, its replacement), joined, then the tail."""
    new = _apply(default)
    if operators:
        cases = " ".join(f"when {lit(entity)} then {_apply(op)}" for entity, op in operators)
        new = f"case x.entity_type {cases} else {new} end"
    new = let("hit", _part("x.`start`", "x.`end`"), new)
    past = "if(i = 0, 0, r[greatest(i - 1, 0)].`end`)"
    piece = f"concat({_part(past, 'x.`start`')}, {new})"
    whole = f"concat(array_join(transform(r, (x, i) -> {piece}), ''), {_part('r[size(r) - 1].`end`', 'length(v.t)')})"
    whole = let("chunks", f"regexp_extract_all(v.t, '(?s).{{1,{CHUNK}}}', 0)", whole)
    spans = resolve_sql("v.s") if resolve else f"coalesce(v.s, {NO_SPANS})"
    return f"if(v.t is null, null, {let('r', spans, f'if(size(r) = 0, v.t, {whole})')})"


def _split(operators: Optional[Mapping[str, OperatorSpec]]) -> tuple[tuple, OperatorSpec]:
    operators = dict(operators or {})
    default = operators.pop("DEFAULT", "replace")
    return tuple((k, tuple(v) if isinstance(v, list) else v) for k, v in sorted(operators.items())), tuple(default) if isinstance(default, list) else default


def _cell(text: Column, spans: Column) -> Column:
    return F.struct(text.cast("string").alias("t"), spans.cast(SPANS_TYPE).alias("s"))


def anonymize_cells(cells: Sequence[tuple[Column, Column]], operators: Optional[Mapping[str, OperatorSpec]] = None) -> Column:
    """:func:`anonymize_text` of several (text, spans) as one array."""
    body = _rewrite_sql(*_split(operators), True)
    return apply(F.array(*[_cell(t, s) for t, s in cells]), f"transform(cells, v -> {body})", "cells")


def anonymize_text(text: Column, spans: Column, operators: Optional[Mapping[str, OperatorSpec]] = None,
                   resolve: bool = True) -> Column:
    """Rewrite ``text`` at ``spans``; a null text stays null.

    Spans are resolved first (overlaps merged), then the output is built
    as one ``array_join`` of (gap, replacement) pieces plus the tail, in time linear in the text and its hits.
    ``operators`` is per entity type; ``DEFAULT`` (or replace) for the others.  With the operators ``pseudonym`` and ``restore`` let
    ``spans`` be a column of the table: with its expression inside, the analyser runs out of passes.
    """
    return apply(_cell(text, spans), _rewrite_sql(*_split(operators), resolve), "v")
