"""SQL text of expressions, applied to columns.

A span expression has a few thousand nodes.  Made one by one from Python it costs seconds
per column; as SQL text it is parsed in the JVM in one call.  The text depends on
recognisers and operators only, so it is built once for each of them, and it has no
column in it: ``apply`` hands it the caller's column as a lambda variable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def apply(value: Column, body: str, name: str = "t") -> Column:
    """``body`` for the column ``value``, which it calls ``name``."""
    bound = F.call_function("transform", F.array(value), F.expr(f"{name} -> {body}"))
    return F.element_at(bound, 1)
