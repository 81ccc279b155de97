"""Python detectors plugged into a scan, Arrow-batched.

Native recognisers cover patterns; a model or a library detector runs here
as an iterator pandas UDF, so whatever it loads is built once per task and
fed whole Arrow batches.  The UDFs return the same span arrays as
``spans.detect``, so they drop into ``scan(detector=...)`` unchanged.
"""

from __future__ import annotations

import re
from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .recognizers import Recognizer
from .spans import SPANS_TYPE

SpanFn = Callable[[str], list]
BatchFn = Callable[[list], list]
NAMES = ("entity_type", "start", "end", "score")


def _spans(fn: BatchFn, texts: pd.Series) -> pd.Series:
    """The spans of each text; nulls are not handed to ``fn`` and have none."""
    known = texts[texts.notna()]
    found = list(fn(known.tolist())) if len(known) else []
    if len(found) != len(known):
        raise ValueError(f"the detector returned {len(found)} results for {len(known)} texts")
    out = pd.Series([[]] * len(texts), index=texts.index, dtype=object)
    for at, spans in zip(known.index, found):
        out.at[at] = [dict(zip(NAMES, (e, int(a), int(b), float(s)))) for e, a, b, s in spans]
    return out


def register_batch_detector(factory: Callable[[], BatchFn]) -> Callable[[Column], Column]:
    """A span detector column function from a detector of many texts at once.

    ``factory()`` is called once per task and returns ``list of texts -> list of
    span lists`` (entity_type, start, end, score); offsets are code points.
    """

    @F.pandas_udf(SPANS_TYPE)
    def _detect(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = factory()
        for texts in batches:
            yield _spans(fn, texts)

    return lambda c: _detect(c.cast("string"))


def register_detector(fn_factory: Callable[[], SpanFn]) -> Callable[[Column], Column]:
    """Like :func:`register_batch_detector` for a detector of one text."""

    def factory():
        fn = fn_factory()
        return lambda texts: [fn(t) for t in texts]

    return register_batch_detector(factory)


def register_row_detector(factory: Callable[[], BatchFn]) -> Callable[[Sequence[Column]], Column]:
    """A function from several columns to an array of their span arrays.

    All columns of a batch of rows cross to Python once and are handed to the
    detector in one call.
    """

    @F.pandas_udf(T.ArrayType(SPANS_TYPE))
    def _detect(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = factory()
        for rows in batches:
            cells = pd.Series([cell for row in rows for cell in row], dtype=object)
            spans, at, out = _spans(fn, cells).tolist(), 0, []
            for row in rows:
                out.append(spans[at:at + len(row)])
                at += len(row)
            yield pd.Series(out, dtype=object)

    return lambda columns: _detect(F.array(*[c.cast("string") for c in columns]))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return bool(digits) and total % 10 == 0


VALIDATORS = {"luhn_check": luhn}


def python_regex_factory(recognizers: Sequence[Recognizer]) -> Callable[[], BatchFn]:
    """The recognisers as a Python batch detector, validators included."""
    unknown = {r.validator for r in recognizers if r.validator} - set(VALIDATORS)
    if unknown:
        raise ValueError(f"no Python form of {sorted(unknown)}")
    specs = [(r.entity_type, r.pattern, r.score, r.validator) for r in recognizers]

    def factory():
        compiled = [(e, re.compile(p), s, VALIDATORS.get(v)) for e, p, s, v in specs]

        def one(text):
            out = [
                (e, m.start(), m.end(), s) for e, rx, s, valid in compiled for m in rx.finditer(text)
                if valid is None or valid(m.group())
            ]
            return sorted(out, key=lambda x: (x[1], -x[2], x[0]))

        return lambda texts: [one(t) for t in texts]

    return factory


def python_regex_detector(recognizers: Sequence[Recognizer]) -> Callable[[Column], Column]:
    """Plug-in twin of the native recognisers, running Python ``re``; it gives the same spans."""
    return register_batch_detector(python_regex_factory(recognizers))
