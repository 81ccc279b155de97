"""DuckDB SQL of the exact-dedup, conversation-repair and manifest queries."""

from __future__ import annotations

from .conversations import CLOSING
from .merkle import COLUMNS, FAN, LOWER, UPPER

EXACT = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)"""


def crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII string, bit by bit: a byte comes in at the first of its eight steps."""
    steps = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [ascii(({text})[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(a, b) >> 1, CASE WHEN (xor(a, b) & 1) = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda a, b: {step}), 4294967295)"


def manifest() -> str:
    """The tree by recursion over its levels, then each document's walk from its leaf to the root."""
    def leaf(text: str) -> str:
        values = [f"CAST({text if c == 'text' else c} AS VARCHAR)" for c in COLUMNS]
        return "sha256(" + " || ".join(f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in values) + ")"

    lowered = f"CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END"
    grow = lambda name, start: f"""{name} AS (  -- tree, level, pos, n, digest
  {start}
  UNION ALL
  SELECT tree, level + 1, pos // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(digest, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY tree, level, n, pos // {FAN})"""  # noqa: E731
    sides = lambda name, nodes: f"""{name} AS (
  SELECT x.tree, x.level, x.pos, coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS l,
    coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS r
  FROM {nodes} x JOIN {nodes} y ON x.tree = y.tree AND x.level = y.level AND x.pos // {FAN} = y.pos // {FAN} WHERE x.n > 1 GROUP BY ALL)"""  # noqa: E731
    walk = lambda name, start, side: f"""{name} AS (  -- row, tree, level, pos, folded, proof
  {start}
  UNION ALL
  SELECT row, w.tree, w.level + 1, w.pos // {FAN}, sha256(l || folded || r), proof || l || r FROM {name} w JOIN {side} s ON s.tree = w.tree AND s.level = w.level AND s.pos = w.pos)"""  # noqa: E731
    last = lambda name: f"(SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1)"
    return f"""
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n, row_number() OVER () AS row
  FROM (SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf('text')} AS leaf, {leaf('(' + lowered + ')')} AS tampered FROM documents)),
{grow("nodes", "SELECT tree, 0 AS level, pos, n, leaf AS digest FROM d")},
tops AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
{grow("crown", "SELECT 0 AS tree, 0 AS level, pos, n, subroot AS digest FROM tops")},
{sides("beside", "nodes")},
{sides("above", "crown")},
{walk("inner_walk", "SELECT row, tree, 0 AS level, pos, tampered AS folded, '' AS proof FROM d", "beside")},
{walk("outer_walk", f"SELECT row, 0 AS tree, 0 AS level, t.pos, folded, proof FROM {last('inner_walk')} i JOIN tops t ON t.tree = i.tree", "above")}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM d JOIN tops ON tops.tree = d.tree JOIN {last('outer_walk')} o ON o.row = d.row, (SELECT digest AS root FROM crown WHERE n = 1)"""


def repair() -> str:
    """Forward costs and least audits per state, row by row; a value is the cost in eight digits, then the audit."""
    code = crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    f = lambda v, k, name: f"printf('%08d', CAST(left({v}, 8) AS INTEGER) + {k}) || substr({v}, 9) || '{name}'"
    insert = "v0, vs, least(vu, " + ", ".join(f("v" + q, 2, "I") for q in "0sa") + ") AS vu, va"
    after = "least(va, " + f("vu", 2, "I") + ") AS va"

    def choices(q: str, kept: str, sources: str) -> str:
        keep = [f"CASE WHEN kind = '{kept}' AND NOT gone THEN {f('v' + p, 'cut', 'K')} END" for p in sources]
        change = [f"CASE WHEN NOT gone THEN {f('v' + p, '2 + cut', 'R')} END" for p in sources] if kept != "s" else []
        return f"least({', '.join([f('v' + q, 3, 'D'), *keep, *change])}) AS v{q}"

    return f"""
WITH RECURSIVE c AS (SELECT *, {code} % 20 AS code FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '{CLOSING}', '') ELSE coalesce(text, ' ') END AS text
  FROM c, unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) WHERE code <> 0),
rows AS (
  SELECT *, coalesce('=' || conv_id, '') AS conv, rtrim(text, {white}) AS ends, sha256(length(role) || ':' || role || text) AS mark,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i FROM damaged),
faults AS (
  SELECT *, CASE WHEN ends = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(ends, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, left(role, 1) AS kind,
    lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) AS earlier FROM rows),
s AS (SELECT conv, i, kind, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS cut FROM faults),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (earlier || kind NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv),
dp AS (
  SELECT conv, 0::BIGINT AS i, '00000000' AS v0, NULL::VARCHAR AS vs, NULL::VARCHAR AS vu, NULL::VARCHAR AS va FROM counts
  UNION ALL
  SELECT conv, i, {f('v0', 3, 'D')} AS v0, {choices('s', 's', '0')}, {choices('u', 'u', '0sa')}, {choices('a', 'a', 'u')}
  FROM (SELECT s.conv, s.i, kind, gone, cut, v0, vs, vu, {after} FROM (SELECT conv, i, {insert} FROM dp) w JOIN s ON s.conv = w.conv AND s.i = w.i + 1)),
best AS (
  SELECT conv, least(v0, va) AS v FROM (SELECT conv, i, v0, vs, vu, {after} FROM (SELECT conv, i, {insert} FROM dp)) QUALIFY row_number() OVER (PARTITION BY conv ORDER BY i DESC) = 1),
audits AS (SELECT conv, CAST(left(v, 8) AS BIGINT) AS cost, substr(v, 9) AS audit FROM best),
marks AS (SELECT conv, p, audit[p] AS edit, length(replace(audit[1:p], 'I', '')) AS i FROM audits, unnest(range(1, length(audit) + 1)) AS x(p)),
kept AS (
  SELECT m.conv, p, edit, r.role, CASE WHEN edit = 'I' THEN '' ELSE r.text END AS text, row_number() OVER w AS j,
    first_value(CASE WHEN edit = 'K' AND left(r.role, 1) = 's' THEN 1 ELSE 0 END) OVER w AS has_system
  FROM marks m LEFT JOIN rows r ON r.conv = m.conv AND r.i = m.i AND m.edit <> 'I' WHERE edit <> 'D' WINDOW w AS (PARTITION BY m.conv ORDER BY p)),
repaired AS (
  SELECT conv, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - has_system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p)) AS digest
  FROM kept GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS conv FROM conversations)
LEFT JOIN counts USING (conv) LEFT JOIN audits USING (conv) LEFT JOIN repaired USING (conv)"""
