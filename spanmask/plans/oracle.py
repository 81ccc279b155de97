"""DuckDB SQL that computes the same answers as the Spark queries.

Used only to check results: every query in the catalogue gets an
independent formulation here (regex lists, prefix sums of lengths,
gaps-and-islands windows), run by DuckDB on the same parquet files.
Patterns have no lookaround, so Java and RE2 read them alike.
"""

from __future__ import annotations

from typing import Sequence

from ..functions.recognizers import PII_MASKED, Recognizer


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def luhn_sql(x: str) -> str:
    """Luhn check of digit string ``x`` in list arithmetic."""
    d = f"CAST(substr(reverse({x}), i, 1) AS INTEGER)"
    return (
        f"(length({x}) > 0 AND list_sum(list_transform(range(1, length({x}) + 1), lambda i: "
        f"CASE WHEN i % 2 = 0 THEN (CASE WHEN 2 * {d} > 9 THEN 2 * {d} - 9 ELSE 2 * {d} END) ELSE {d} END)) % 10 = 0)"
    )


def span_rows(table: str, key: str, text: str, rec: Recognizer, key_alias: str = None,
              column_name: str = None) -> str:
    """One row per hit: key, [column,] entity_type, start, end, score, matched."""
    p = lit(rec.pattern)
    ka = key_alias or key
    col_sel = f"{lit(column_name)} AS \"column\", " if column_name is not None else ""
    start = (
        "CAST(coalesce(list_sum(list_transform(t.p[1:u.i], lambda x: length(x))), 0)"
        " + coalesce(list_sum(list_transform(t.m[1:u.i - 1], lambda x: length(x))), 0) AS INTEGER)"
    )
    sql = (
        f"SELECT t.k AS {ka}, {col_sel}{lit(rec.entity_type)} AS entity_type, {start} AS start, "
        f"CAST({start} + length(t.m[u.i]) AS INTEGER) AS \"end\", CAST({rec.score!r} AS DOUBLE) AS score, "
        f"t.m[u.i] AS matched "
        f"FROM (SELECT {key} AS k, regexp_extract_all(CAST({text} AS VARCHAR), {p}) AS m, "
        f"string_split_regex(CAST({text} AS VARCHAR), {p}) AS p FROM {table}) t, "
        f"unnest(range(1, len(t.m) + 1)) AS u(i)"
    )
    if rec.validator == "luhn_check":
        sql = f"SELECT * FROM ({sql}) WHERE {luhn_sql('matched')}"
    elif rec.validator:
        raise ValueError(f"no SQL twin for validator {rec.validator}")
    return sql


def all_span_rows(table: str, key: str, columns: Sequence[str], recs: Sequence[Recognizer],
                  key_alias: str = None) -> str:
    parts = [span_rows(table, key, c, r, key_alias, column_name=c) for c in columns for r in recs]
    return " UNION ALL ".join(f"({p})" for p in parts)


def count_expr(text: str, recs: Sequence[Recognizer]) -> str:
    """Number of hits of all recognisers in one cell (0 for null)."""
    terms = []
    for r in recs:
        m = f"regexp_extract_all(CAST({text} AS VARCHAR), {lit(r.pattern)})"
        if r.validator == "luhn_check":
            m = f"list_filter({m}, lambda c: {luhn_sql('c')})"
        terms.append(f"coalesce(len({m}), 0)")
    return "CAST(" + " + ".join(terms) + " AS INTEGER)"


HIT = 'substr(d.v, g.start + 1, g."end" - g.start)'


def rewrite(spans_sql: str, source: str, key: str, text: str, replacement: str, carry: str = "") -> str:
    """Texts rebuilt from the resolved spans: gap, replacement, gap, ..., tail.

    ``replacement`` is SQL over ``g.entity_type`` and ``HIT``; ``carry`` names more columns of the source.
    """
    more = "".join(f", d.{c}" for c in carry.split(",") if c)
    return f"""
WITH d AS (SELECT {key} AS k, CAST({text} AS VARCHAR) AS v{"".join(f", {c}" for c in carry.split(",") if c)} FROM {source}),
i AS ({islands(spans_sql, key)}),
g AS (SELECT {key} AS k, start, "end", entity_type, coalesce(lag("end") OVER (PARTITION BY {key} ORDER BY start), 0) AS past FROM i),
p AS (
  SELECT g.k, string_agg(substr(d.v, g.past + 1, g.start - g.past) || {replacement}, '' ORDER BY g.start) AS head, max(g."end") AS last
  FROM g JOIN d ON g.k = d.k GROUP BY g.k)
SELECT d.k AS {key}, CASE WHEN p.head IS NULL THEN d.v ELSE p.head || substr(d.v, p.last + 1) END AS {text}{more}
FROM d LEFT JOIN p ON d.k = p.k"""


REPLACE = "'<' || g.entity_type || '>'"
REDACT = "''"
HASH = f"sha256({HIT})"
MASK = f"regexp_replace(regexp_replace(regexp_replace({HIT}, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')"
KEEP = HIT


def synth_customers(source: str, texts: int, seed: int) -> str:
    """The synthetic customers in SQL: every value a function of md5 of (id, seed, tag)."""
    from ..sources import synth as S

    def u(tag: str) -> str:
        return f"(CAST('0x' || substr(md5(id || '|{seed}|' || {tag}), 1, 7) AS BIGINT) / 268435456.0)"

    def pick(values, tag: str) -> str:
        items = ", ".join(lit(v) for v in values)
        return f"[{items}][CAST(floor({u(tag)} * {len(values)}) AS INTEGER) + 1]"

    def whole(tag: str, n: int, low: int) -> str:
        return f"(CAST(floor({u(tag)} * {n}) AS INTEGER) + {low})"

    def free(k: int) -> str:
        tag = f"text{k}"
        word = pick(S.WORDS, f"'{tag}w' || i || '.' || j")
        words = f"list_transform(range(1, {whole(f"'{tag}s' || i", 6, 4)} + 1), lambda j: {word})"
        cap = f"list_transform({words}, lambda w: upper(w[1]) || w[2:])"
        body = f"array_to_string(list_transform(range(1, {whole(lit(tag), 8, 3)} + 1), lambda i: array_to_string({cap}, ' ') || '.'), ' ')"
        share = u(lit(tag + "pii"))
        return (f"{body} || CASE WHEN {share} < 0.2 THEN ' Write to ' || email || '.' "
                f"WHEN {share} < 0.35 THEN ' Call ' || phone || '.' ELSE '' END AS freetext_{k}")

    total, acc, cases = sum(w for _, w in S.OPERATIONS), 0.0, []
    for name, w in S.OPERATIONS:
        acc += w
        cases.append(f"WHEN {u(lit('op'))} * {total!r}::DOUBLE < {acc!r}::DOUBLE THEN {'NULL' if name is None else lit(name)}")
    return f"""
WITH a AS (
  SELECT id, {pick(S.FIRST, lit("first"))} AS firstname, {pick(S.LAST, lit("last"))} AS lastname,
    printf('+1 (%03d) 555-%04d', {whole(lit("ph1"), 800, 200)}, {whole(lit("ph2"), 10000, 0)}) AS phone FROM {source}),
b AS (SELECT *, lower(firstname) || '.' || lower(lastname) || '@' || {pick(S.DOMAINS, lit("dom"))} AS email FROM a)
SELECT id, firstname, lastname, email,
  printf('%d %s, %s', {whole(lit("no"), 999, 1)}, {pick(S.STREETS, lit("street"))}, {pick(S.CITIES, lit("city"))}) AS address,
  CASE {' '.join(cases)} ELSE NULL END AS operation, {', '.join(free(k) for k in range(1, texts + 1))},
  strftime(make_timestamp((1764547200 + CAST(floor({u(lit("ts"))} * 2592000) AS BIGINT)) * 1000000), '%m-%d-%Y %H:%M:%S') AS operation_date
FROM b"""


def islands(spans_sql: str, key: str) -> str:
    """Gaps-and-islands over span rows ``key, entity_type, start, end, score``."""
    return f"""
WITH s AS ({spans_sql}),
o AS (
  SELECT *, max("end") OVER (PARTITION BY {key} ORDER BY start, "end" DESC, entity_type
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end
  FROM s),
g AS (
  SELECT *, sum(CASE WHEN prev_end IS NULL OR prev_end <= start THEN 1 ELSE 0 END)
            OVER (PARTITION BY {key} ORDER BY start, "end" DESC, entity_type
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
  FROM o),
r AS (
  SELECT *, row_number() OVER (PARTITION BY {key}, island ORDER BY score DESC, start, "end" DESC, entity_type) AS rk,
            min(start) OVER (PARTITION BY {key}, island) AS i_start,
            max("end") OVER (PARTITION BY {key}, island) AS i_end
  FROM g)
SELECT {key}, CAST(i_start AS INTEGER) AS start, CAST(i_end AS INTEGER) AS "end", entity_type
FROM r WHERE rk = 1
"""


def rescored(spans_sql: str, source: str, key: str, text: str, contexts, min_score: float) -> str:
    """Spans with scores moved by context words: words and spans joined on their positions."""
    w = r"'\p{L}+'"
    rules = ", ".join(f"({lit(e)}, {lit(x)}, {sign}, {c.window})" for e, c in contexts.items() for listed, sign in ((c.raises, 1), (c.lowers, -1)) for x in listed)
    moves = ", ".join(f"({lit(e)}, {c.raise_by!r}::DOUBLE, {c.lower_by!r}::DOUBLE)" for e, c in contexts.items())
    return f"""
WITH s AS ({spans_sql}),
t AS (SELECT {key} AS k, regexp_extract_all({text}, {w}) AS m, string_split_regex({text}, {w}) AS p FROM {source} WHERE {key} IN (SELECT {key} FROM s)),
u AS (SELECT k, i, m[i] AS tok, length(p[i]) + length(m[i]) AS step FROM t, unnest(range(1, len(m) + 1)) AS x(i)),
v AS (SELECT k, i, lower(tok) AS word, sum(step) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b, length(tok) AS n FROM u),
b AS (
  SELECT s.{key}, entity_type, start, "end", score, count(v.i) FILTER (v.b <= start) AS nb, count(v.i) FILTER (v.b - v.n < "end") AS na
  FROM s LEFT JOIN v ON v.k = s.{key} GROUP BY ALL),
rules(entity_type, word, sign, reach) AS (VALUES {rules}),
moves(entity_type, up, down) AS (VALUES {moves}),
h AS (
  SELECT b.{key}, b.entity_type, start, "end", bool_or(sign > 0) AS raised, bool_or(sign < 0) AS lowered
  FROM b JOIN rules r ON r.entity_type = b.entity_type
  JOIN v ON v.k = b.{key} AND v.word = r.word AND (v.i > nb - reach AND v.i <= nb OR v.i > na AND v.i <= na + reach) GROUP BY ALL)
SELECT * FROM (
  SELECT b.{key}, b.entity_type, b.start, b."end", CASE WHEN up IS NULL THEN score ELSE round(greatest(0, least(1,
    score + CASE WHEN raised THEN up ELSE 0 END - CASE WHEN lowered THEN down ELSE 0 END)), 6) END AS score
  FROM b LEFT JOIN moves USING (entity_type)
  LEFT JOIN h ON h.{key} = b.{key} AND h.entity_type = b.entity_type AND h.start = b.start AND h."end" = b."end")
WHERE score >= {min_score!r}"""


MASKED = lit(PII_MASKED)


def advice(name: str, table: str, key: str, column: str, recs: Sequence[Recognizer], low: float, high: float, z: float, first: int, growth: int) -> str:
    """The column advice: shares and their bounds at every sample size, the first size that decides."""
    spans = " UNION ALL ".join(f"({span_rows(table, key, column, r, key_alias='k')})" for r in recs)

    def bound(hits: str, sign: str) -> str:
        p, zz = f"({hits}::DOUBLE / f)", f"({z} * {z}::DOUBLE / f)"
        inner = f"({p} + {zz} / 2 {sign} {z}::DOUBLE * sqrt({p} * (1 - {p}) / f + {zz} / (4 * f))) / (1 + {zz})"
        return f"CASE WHEN f = 0 THEN {0.0 if sign == '-' else 1.0} ELSE least(1.0, greatest(0.0, {inner})) END"

    return f"""
SELECT {lit(name)} AS "table", {lit(column)} AS "column", advice, n AS sampled, f AS filled, h AS hits, w AS whole,
  round(hl, 6) AS hit_low, round(hh, 6) AS hit_high, round(wl, 6) AS whole_low, round(wh, 6) AS whole_high
FROM (
  SELECT *, CASE WHEN n >= total THEN CASE WHEN f > 0 AND w >= {high}::DOUBLE * f THEN 'known' WHEN h <= {low}::DOUBLE * f THEN 'exclude' ELSE 'scan' END
    WHEN wl >= {high} THEN 'known' WHEN hh <= {low} THEN 'exclude' WHEN hl > {low} AND wh < {high} THEN 'scan' END AS advice
  FROM (
    SELECT *, {bound('h', '-')} AS hl, {bound('h', '+')} AS hh, {bound('w', '-')} AS wl, {bound('w', '+')} AS wh
    FROM (
      SELECT s.n, any_value(total) AS total, count(*) FILTER (filled AND place <= s.n) AS f, count(*) FILTER (filled AND hit AND place <= s.n) AS h,
        count(*) FILTER (filled AND hit AND covered AND place <= s.n) AS w
      FROM (
        SELECT coalesce(length(trim(v, ' ')), 0) > 0 AS filled, c.n IS NOT NULL AS hit, coalesce(c.n >= length(trim(v, ' ')), false) AS covered,
          row_number() OVER (ORDER BY md5(CAST(k AS VARCHAR))) AS place, count(*) OVER () AS total
        FROM (SELECT {key} AS k, CAST({column} AS VARCHAR) AS v FROM {table}) t
        LEFT JOIN (SELECT k, sum("end" - start) AS n FROM ({islands(spans, 'k')}) GROUP BY k) c USING (k)) cells,
      (SELECT DISTINCT least((SELECT count(*) FROM {table}), {first} * {growth} ** r)::BIGINT AS n FROM range(14) AS x(r)) s
      GROUP BY s.n)))
WHERE advice IS NOT NULL QUALIFY row_number() OVER (ORDER BY n) = 1"""


def pseudonyms(spans: str, key: str, rounds: int) -> str:
    """Pseudonyms of card and phone numbers (up to 16 digits: one network), round by round."""
    digest = lambda value, r: (
        f"CAST('0x' || substr(sha256(concat_ws('|', {lit(key)}, entity_type, '10', n, 0, {r}, {value})), 1, 15) AS BIGINT)")
    state = f"""
SELECT *, length(body) AS n, length(body) // 2 AS half, CAST(left(body, length(body) // 2) AS BIGINT) AS a, CAST(substr(body, length(body) // 2 + 1) AS BIGINT) AS b
FROM (SELECT *, CASE entity_type WHEN 'CREDIT_CARD' THEN left(matched, length(matched) - 1) ELSE substr(regexp_replace(matched, '[^0-9]', '', 'g'), 2) END AS body FROM ({spans}))"""
    for r in range(rounds):
        half, size = ("a", "half") if r % 2 == 0 else ("b", "(n - half)")
        other = "b" if half == "a" else "a"
        new = f"({half} + {digest(other, r)} % CAST(10 ** {size} AS BIGINT)) % CAST(10 ** {size} AS BIGINT) AS {half}"
        state = f"SELECT * EXCLUDE ({half}), {new} FROM ({state})"
    total = ("list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN (length(d) - i) % 2 = 0 AND CAST(d[i] AS INTEGER) > 4 THEN 2 * CAST(d[i] AS INTEGER) - 9 "
             "WHEN (length(d) - i) % 2 = 0 THEN 2 * CAST(d[i] AS INTEGER) ELSE CAST(d[i] AS INTEGER) END))")
    return f"""
SELECT doc_id, entity_type, start, "end", CASE entity_type WHEN 'CREDIT_CARD' THEN d || CAST((10 - {total} % 10) % 10 AS VARCHAR)
  ELSE '+1 (' || d[1:3] || ') ' || d[4:6] || '-' || d[7:10] END AS pseudonym
FROM (SELECT *, lpad(CAST(a AS VARCHAR), CAST(half AS INTEGER), '0') || lpad(CAST(b AS VARCHAR), CAST(n - half AS INTEGER), '0') AS d FROM ({state}))"""
