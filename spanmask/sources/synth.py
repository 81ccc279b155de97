"""Repeatable synthetic ``customers`` table, built from native expressions.

Every value is a pure function of (id, seed), so a rerun -- or a retried
task -- gives the same rows; no Python UDF is involved.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------
# Operation weights (renormalised over their sum, 0.91): APPEND 0.5,
# DELETE 0.1, UPDATE 0.3, null 0.01.  Date format: MM-dd-yyyy HH:mm:ss.
OPERATIONS = (("APPEND", 0.5), ("DELETE", 0.1), ("UPDATE", 0.3), (None, 0.01))
DATE_FORMAT = "MM-dd-yyyy HH:mm:ss"
FIRST = ("Anna", "Ben", "Carla", "David", "Elena", "Felix", "Grace", "Hugo", "Ines", "Jonas",
         "Klara", "Liam", "Mia", "Noah", "Olga", "Paul", "Rosa", "Sam", "Tara", "Victor")
LAST = ("Adler", "Brown", "Costa", "Dubois", "Evans", "Fischer", "Garcia", "Hansen", "Ito", "Jansen",
        "Keller", "Lopez", "Martin", "Novak", "Olsen", "Perez", "Quinn", "Rossi", "Schmidt", "Weber")
STREETS = ("Oak Street", "Maple Avenue", "Hill Road", "Lake Drive", "Park Lane", "River Way")
CITIES = ("Springfield", "Riverton", "Lakeside", "Fairview", "Greenville", "Hillcrest")
DOMAINS = ("example.com", "example.org", "example.net")
WORDS = ("account", "order", "delivery", "support", "request", "invoice", "payment", "service",
         "customer", "update", "please", "contact", "number", "call", "email", "address", "new",
         "the", "my", "was", "is", "for", "with", "about", "today", "again", "thanks", "issue")
# -------------------------------------------------------------------------


def _u(id_col: Column, seed: int, tag: str | Column) -> Column:
    """Uniform in [0, 1): 28 bits of md5 of (id, seed, tag), which other engines have too."""
    tag = F.lit(tag) if isinstance(tag, str) else tag
    digest = F.md5(F.concat(id_col.cast("string"), F.lit(f"|{seed}|"), tag).cast("binary"))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") / F.lit(268435456.0)


def _whole(id_col: Column, seed: int, tag: str | Column, n: int, low: int) -> Column:
    return (F.floor(_u(id_col, seed, tag) * n) + low).cast("int")


def _pick(values, id_col: Column, seed: int, tag: str | Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), _whole(id_col, seed, tag, len(values), 1))


def _sentence(id_col: Column, seed: int, tag: str, i: Column) -> Column:
    number = i.cast("string")
    n = _whole(id_col, seed, F.concat(F.lit(tag + "s"), number), 6, 4)
    words = F.transform(F.sequence(F.lit(1), n), lambda j: _pick(
        WORDS, id_col, seed, F.concat(F.lit(tag + "w"), number, F.lit("."), j.cast("string"))))
    return F.concat(F.initcap(F.array_join(words, " ")), F.lit("."))


def _freetext(id_col: Column, seed: int, k: int, email: Column, phone: Column) -> Column:
    tag = f"text{k}"
    n = _whole(id_col, seed, tag, 8, 3)   # 3..10 sentences
    body = F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: _sentence(id_col, seed, tag, i)), " ")
    pii = _u(id_col, seed, tag + "pii")
    return (F.when(pii < 0.2, F.concat(body, F.lit(" Write to "), email, F.lit(".")))
            .when(pii < 0.35, F.concat(body, F.lit(" Call "), phone, F.lit(".")))
            .otherwise(body))


def synth_customers(spark: SparkSession, n: Optional[int] = None, freetext_cols: int = 1, seed: int = 42,
                    parts: Optional[int] = None, ids: Optional[DataFrame] = None) -> DataFrame:
    """``id, firstname, lastname, email, address, operation, freetext_1..k, operation_date``.

    Ids come from ``spark.range(n)`` or from the ``id`` column of ``ids``.
    """
    base = ids.select(F.col("id").cast("long").alias("id")) if ids is not None else spark.range(int(n or 0))
    if parts:
        base = base.repartition(parts)
    i = F.col("id")
    first = _pick(FIRST, i, seed, "first")
    last = _pick(LAST, i, seed, "last")
    email = F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@"), _pick(DOMAINS, i, seed, "dom"))
    phone = F.format_string("+1 (%03d) 555-%04d", (F.floor(_u(i, seed, "ph1") * 800) + 200).cast("int"),
                            F.floor(_u(i, seed, "ph2") * 10000).cast("int"))
    address = F.format_string("%d %s, %s", (F.floor(_u(i, seed, "no") * 999) + 1).cast("int"),
                              _pick(STREETS, i, seed, "street"), _pick(CITIES, i, seed, "city"))
    total = sum(w for _, w in OPERATIONS)
    u = _u(i, seed, "op") * total
    op, acc = None, 0.0
    for name, w in OPERATIONS:
        acc += w
        cond = u < F.lit(acc)
        val = F.lit(name).cast("string")
        op = F.when(cond, val) if op is None else op.when(cond, val)
    operation = op.otherwise(F.lit(None).cast("string"))
    ts = F.timestamp_seconds(F.lit(1_764_547_200) + F.floor(_u(i, seed, "ts") * 2_592_000).cast("long"))
    texts = [_freetext(i, seed, k, email, phone).alias(f"freetext_{k}") for k in range(1, freetext_cols + 1)]
    return base.select(
        i, first.alias("firstname"), last.alias("lastname"), email.alias("email"), address.alias("address"),
        operation.alias("operation"), *texts, F.date_format(ts, DATE_FORMAT).alias("operation_date"),
    )
