"""Structure repair of conversations by a run-length min-plus program.

A repaired conversation is empty, or an optional system row followed by pairs of a user and an assistant row.  Each row has
a symbol: its role's initial and whether it is cut short, or that it must go (blank, or a repetition).  An edit
(keep, re-role, delete, insert) moves an automaton of four states at a cost, so a symbol is a 4 x 4 matrix in min-plus algebra,
and a run of equal symbols is a power of it, put together from cached binary powers.

A conversation of any length is cut into segments of SEGMENT rows.  One job turns segments into matrices; a second, which sees
one matrix per segment, gives every segment the costs to come after it; a third goes back over the runs of
each segment and unrolls the choices, for each state in which the segment may be entered; a fourth picks the
state that the segments before lead to.  Texts move once, for the repaired rows.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import placed, run_starts
from .store import written

# Edit costs, roles, white space and closing marks.
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
WHITE = " \t\n\x0b\x0c\r"
CLOSING = ".!?"

#: Rows of a conversation that one task looks at together.
SEGMENT = 1 << 16

# States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEVER = 1 << 50
_WANTED = (USER, USER, ASSISTANT, USER)                  # the state that a new or re-roled row leads to
_KEPT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None), "": (None,) * 4}
#: Costs to come after the last row: rows are inserted up to the end of a pair.
END = (0, 2 * INSERT, INSERT, 0)
GONE, CLASSES = 0, ("s", "u", "a", "")                   # symbols: 0, and 1 + 2 * class + (cut short)


@lru_cache(maxsize=None)
def edits(symbol: int) -> tuple:
    """Per state: (initial, cost, next state) of the edits of a row, in the order of their initials."""
    if symbol == GONE:
        return tuple((("D", DELETE, q),) for q in range(4))
    kept, extra = _KEPT[CLASSES[(symbol - 1) // 2]], CUT_SHORT * ((symbol - 1) % 2)
    out = []
    for q in range(4):
        keep = ((("K", KEEP + extra, kept[q]),) if kept[q] is not None else ())
        out.append((("D", DELETE, q), *keep, ("R", REROLE + extra, _WANTED[q])))
    return tuple(out)


def product(a: tuple, b: tuple) -> tuple:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def advance(matrix: tuple, after: tuple) -> tuple:
    """Costs to come before a matrix, from those after it."""
    return tuple(min(row[k] + after[k] for k in range(4)) for row in matrix)


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> tuple:
    """The min-plus matrix of 2**k rows of one symbol."""
    if k:
        return product(power(symbol, k - 1), power(symbol, k - 1))
    insert = [[0 if i == j else _NEVER for j in range(4)] for i in range(4)]
    for q in range(4):                                   # any number of rows before this one
        insert[q][_WANTED[q]] = min(insert[q][_WANTED[q]], INSERT)
        second = _WANTED[_WANTED[q]]
        insert[q][second] = min(insert[q][second], 2 * INSERT)
    row = [[_NEVER] * 4 for _ in range(4)]
    for q, choices in enumerate(edits(symbol)):
        for _, cost, to in choices:
            row[q][to] = min(row[q][to], cost)
    return product(tuple(map(tuple, insert)), tuple(map(tuple, row)))


def runs(symbols: np.ndarray) -> list[tuple[int, int]]:
    """(symbol, length) of the runs of equal symbols."""
    at = np.flatnonzero(np.diff(symbols, prepend=-1))
    return list(zip(symbols[at].tolist(), np.diff(at, append=len(symbols)).tolist()))


def segment_matrix(symbols: np.ndarray) -> tuple:
    out = tuple(tuple(0 if i == j else _NEVER for j in range(4)) for i in range(4))
    for symbol, length in runs(symbols):
        k = 0
        while length >> k:
            if length >> k & 1:
                out = product(out, power(symbol, k))
            k += 1
    return out


def unroll(symbols: np.ndarray, after: tuple, entries: tuple) -> list[tuple[int, str]]:
    """(last state, initials) of the cheapest edits of a segment, least in ASCII, for each state of ``entries``."""
    parts, bounds = runs(symbols), [tuple(after)]
    for symbol, length in reversed(parts):               # costs at the ends of runs, by binary powers
        costs, k = bounds[-1], 0
        while length >> k:
            if length >> k & 1:
                costs = advance(power(symbol, k), costs)
            k += 1
        bounds.append(costs)
    walks = [[q, []] for q in entries]
    for i, (symbol, length) in enumerate(parts):
        steps = [bounds[len(parts) - 1 - i]]
        for _ in range(length):                          # costs inside the run, one row at a time
            steps.append(advance(power(symbol, 0), steps[-1]))
        choices = edits(symbol)
        for at in range(length, 0, -1):
            here, there = steps[at], steps[at - 1]
            for walk in walks:
                while True:
                    q = walk[0]
                    options = [(name, to) for name, cost, to in choices[q] if cost + there[to] == here[q]]
                    if INSERT + here[_WANTED[q]] == here[q]:
                        options.append(("I", _WANTED[q]))
                    name, walk[0] = min(options)
                    walk[1].append(name)
                    if name != "I":
                        break
    return [(q, "".join(names)) for q, names in walks]


# --- jobs ---------------------------------------------------------------------

def _segments(batches):
    """(conv, seg, symbols, initials) of each segment of rows that are sorted by (conv, seg, at)."""
    conv, seg, held = None, None, []

    def whole():
        return conv, seg, np.concatenate([h[0] for h in held]), [x for h in held for x in h[1]], held[0][2]

    for batch in batches:
        if not batch.num_rows:
            continue
        names, segs = batch.column("conv"), batch.column("seg").to_numpy()
        new = run_starts(names, conv)
        new[1:] |= segs[1:] != segs[:-1]
        new[0] |= segs[0] != seg
        symbols, initials = batch.column("symbol").to_numpy(), batch.column("initial").to_pylist()
        after = batch.column("after") if "after" in batch.schema.names else None
        starts = np.flatnonzero(new)
        cuts = sorted({0, *starts.tolist()})
        for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
            if new[a] and held:
                yield whole()
                held = []
            conv, seg = names[a].as_py(), int(segs[a])
            held.append((symbols[a:b], initials[a:b], after[a].as_py() if after is not None and not held else None))
    if held:
        yield whole()


def _blocks(rows, schema: pa.Schema, size: int = 4096):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


LEGAL = frozenset(("su", "ua", "au"))
_MATRIX = pa.schema([("conv", pa.string()), ("seg", pa.int64()), ("matrix", pa.list_(pa.int64())), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string())])


def _matrices(batches):
    return _blocks(({
        "conv": conv, "seg": seg, "matrix": [x for row in segment_matrix(symbols) for x in row],
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), "first": initials[0], "last": initials[-1],
    } for conv, seg, symbols, initials, _ in _segments(batches)), _MATRIX)


_AFTER = pa.schema([("conv", pa.string()), ("seg", pa.int64()), ("after", pa.list_(pa.int64())), ("cost", pa.int64()), ("illegal", pa.int64())])


def _suffixes(batches):
    """Costs after each segment of a conversation; its whole cost and its illegal pairs."""

    def rows():
        for batch in batches:
            for conv, parts in zip(batch.column("conv"), batch.column("parts")):
                parts, after, out = parts.as_py(), END, []
                for part in reversed(parts):
                    out.append((part["seg"], after))
                    m = part["matrix"]
                    after = advance(tuple(tuple(m[i:i + 4]) for i in range(0, 16, 4)), after)
                illegal = sum(p["illegal"] for p in parts) + sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:]))
                for seg, costs in out:
                    yield {"conv": conv.as_py(), "seg": seg, "after": list(costs), "cost": after[START], "illegal": illegal}

    return _blocks(rows(), _AFTER)


_CHOICES = pa.schema([("conv", pa.string()), ("seg", pa.int64()), ("exits", pa.list_(pa.int32())), ("audits", pa.list_(pa.string()))])


def _choices(batches):
    def rows():
        for conv, seg, symbols, _, after in _segments(batches):
            entries = (START, SYSTEM, USER, ASSISTANT) if seg else (START,)
            found = unroll(symbols, after, entries)
            yield {"conv": conv, "seg": seg, "exits": [q for q, _ in found], "audits": [a for _, a in found]}

    return _blocks(rows(), _CHOICES, 64)


_AUDIT = pa.schema([("conv", pa.string()), ("audit", pa.string())])


def _chains(batches):
    def rows():
        for batch in batches:
            for conv, parts in zip(batch.column("conv"), batch.column("parts")):
                q, out = START, []
                for part in parts:
                    out.append(part["audits"][q].as_py())
                    q = part["exits"][q].as_py()
                out.append("I" * (END[q] // INSERT))
                yield {"conv": conv.as_py(), "audit": "".join(out)}

    return _blocks(rows(), _AUDIT, 64)


class Editor:
    """Applies an audit to the rows of one conversation as they pass."""

    def __init__(self, conv: str, audit: str):
        self.conv, self.audit, self.at, self.state = conv, audit, 0, START

    def inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at, self.state = self.at + 1, _WANTED[self.state]
            yield "I", ROLES["u" if self.state == USER else "a"], ""

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = _KEPT[role[:1]][self.state]
            yield edit, role, text
        elif edit == "R":
            self.state = _WANTED[self.state]
            yield edit, ROLES["u" if self.state == USER else "a"], text


def _edited(batches):
    """(conv, edits, first?, last?): the edited rows, as rows sorted by (conv, kind, place) pass."""
    editor = None
    for batch in batches:
        for i in range(batch.num_rows):
            if batch.column("kind")[i].as_py() == 0:
                if editor:
                    yield editor.conv, editor.inserted(), True
                editor = Editor(batch.column("conv")[i].as_py(), batch.column("audit")[i].as_py())
            else:
                yield editor.conv, editor.row(batch.column("role")[i].as_py(), batch.column("text")[i].as_py()), False
    if editor:
        yield editor.conv, editor.inserted(), True


_ROWS = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _repaired(batches):
    held, size, place = [], 0, 0
    for conv, found, last in _edited(batches):
        for edit, role, text in found:
            held.append({"conv": conv, "place": place, "edit": edit, "role": role, "text": text})
            size, place = size + len(text), place + 1
        if size > 1 << 20 or len(held) > 4096:
            yield pa.RecordBatch.from_pylist(held, _ROWS)
            held, size = [], 0
        if last:
            place = 0
    if held:
        yield pa.RecordBatch.from_pylist(held, _ROWS)


_DIGEST = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])


def _digests(batches):
    def rows():
        state, first = sha256(), True
        for conv, found, last in _edited(batches):
            for _, role, text in found:
                state.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
            if last:
                yield {"conv": conv, "repaired_sha256": state.hexdigest()}
                state, first = sha256(), True

    return _blocks(rows(), _DIGEST)


def _key(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def _rows(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(_key(F.col("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.withColumn("mark", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def symbols(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv, turn, at, seg, initial, fault, symbol) of each row, without its text; written.

    fault: 1 blank, 2 repetition of an earlier row's role and text, 3 cut short, else 0; the first that holds.
    """
    ends = F.rtrim("text", F.lit(WHITE))
    narrow = rows.select(
        "conv", "turn", "role", "mark", (ends == "").alias("blank"), (~F.substring(ends, -1, 1).isin(*CLOSING)).alias("short"))
    at = placed(narrow, "conv", ["turn", "role", "mark"], "turns")
    first = at.groupBy("conv", "mark").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("conv", "mark", "first")
    again = F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), 1).when(again, 2).when(F.col("short"), 3).otherwise(0)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    symbol = F.when(F.col("fault").isin(1, 2), GONE).otherwise(1 + 2 * kind + (F.col("fault") == 3).cast("int"))
    out = at.join(first, ["conv", "mark"], "left").withColumn("fault", fault)
    return written(out.select("conv", "turn", "at", F.expr(f"at div {segment}").alias("seg"), initial.alias("initial"), "fault", symbol.alias("symbol")), "symbols")


def _audits(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, cost, illegal) and (conv, audit), written."""
    by_segment = lambda df: df.repartition("conv", "seg").sortWithinPartitions("conv", "seg", "at")
    rows = marked.select("conv", "seg", "at", "symbol", "initial")
    matrices = by_segment(rows).mapInArrow(_matrices, "conv string, seg long, matrix array<long>, illegal long, first string, last string")
    parts = matrices.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("seg", "matrix", "illegal", "first", "last"))).alias("parts"))
    after = written(parts.mapInArrow(_suffixes, "conv string, seg long, after array<long>, cost long, illegal long"), "suffixes")
    chosen = by_segment(rows.join(after.select("conv", "seg", "after"), ["conv", "seg"])).mapInArrow(_choices, "conv string, seg long, exits array<int>, audits array<string>")
    chains = chosen.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("seg", "exits", "audits"))).alias("parts"))
    return after.where("seg = 0").select("conv", "cost", "illegal"), written(chains.mapInArrow(_chains, "conv string, audit string"), "audits")


def _stream(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one task."""
    control = audits.select("conv", F.lit(0).alias("kind"), "audit")
    texts = rows.withColumn("kind", F.lit(1))
    both = texts.unionByName(control, allowMissingColumns=True).select("conv", "kind", "turn", "role", "mark", "text", "audit")
    return both.repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "mark")


def repaired_rows(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The rows after repair: conv_id, place (from 0), edit (K, R or I), role, text; see :func:`repair`."""
    rows = _rows(conversations)
    _, audits = _audits(symbols(rows, segment))
    out = _stream(rows, audits).mapInArrow(_repaired, "conv string, place long, edit string, role string, text string")
    return out.select(_id(conversations), "place", "edit", "role", "text")


def _id(conversations: DataFrame) -> Column:
    kind = conversations.schema["conv_id"].dataType
    return F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind).alias("conv_id")


def repair(conversations: DataFrame, ids: DataFrame | None = None, segment: int = SEGMENT) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``conversations`` has conv_id, turn, role and text.  Rows go by turn, nulls first; rows of equal turn by role, then by a digest
    of role and text.  A null conv_id is a conversation; a null role or text is one space.  Counts are of rows by their first fault, ``illegal`` of
    neighbours whose role initials are none of su, ua, au.  The audit is the cheapest list of edits (Keep, Rerole, Delete, Insert), of those
    the least in ASCII, and the digest is that of the repaired rows ``role:text`` joined by newlines.  ``ids`` (conv_id)
    adds conversations without rows: zeros, an empty audit and the digest of the empty text.  An empty table gives an empty result; other
    columns are ignored.  The digest is one sequence, so a conversation's repaired text streams through one task, row by row.
    """
    rows = _rows(conversations)
    marked = symbols(rows, segment)
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = marked.groupBy("conv").agg(F.coalesce(span, F.lit(0)).alias("gaps"), *[
        F.count_if(F.col("fault") == i).alias(name) for i, name in ((1, "blank"), (2, "duplicate"), (3, "truncated"))])
    costs, audits = _audits(marked)
    digests = _stream(rows, audits).mapInArrow(_digests, "conv string, repaired_sha256 string")
    out = counts.join(costs, "conv").join(audits, "conv").join(digests, "conv")
    if ids is not None:
        out = ids.select(_key(F.col("conv_id")).alias("conv")).distinct().join(out, "conv", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(sha256().hexdigest())
    return out.select(_id(conversations), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text), damaged by crc32(``conv_id:turn``) % 20, nulls as one space.

    0: the row is gone; 1: its text is empty; 2: its closing marks are gone; 3: it stands twice; 4: its role is user.
    """
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", or_space("role").alias("role"), or_space("text").alias("text"), code.alias("code"))
    rows = rows.where("code <> 0").withColumns({
        "text": F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", CLOSING, "")).otherwise(F.col("text")),
        "role": F.when(F.col("code") == 4, "user").otherwise(F.col("role")),
    })
    times = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("time", F.explode(times)).select("conv_id", "turn", "role", "text")
