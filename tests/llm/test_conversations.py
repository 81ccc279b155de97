import hashlib
import heapq
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanmask.llm import conversations as C

SPACE = "[^\x20\x09-\x0d]"


def cheapest(rows):
    """(cost, audit, repaired rows) over all edit sequences: least cost first, then least audit.  rows: (role, text, fault)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, out = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, out
        state = (i, "" if not roles else roles if roles == "s" else roles[-1])
        if state in done:                                # two audits that lead here at equal cost are no prefixes of each other
            continue
        done.add(state)
        moves = [("I", 2, r, (C.ROLES[r], "")) for r in "ua"]
        if i < len(rows):
            role, text, fault = rows[i]
            moves.append(("D", 3, None, None))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                moves.append(("K", extra, role[:1] or "?", (role, text)))
                moves += [("R", 2 + extra, r, (C.ROLES[r], text)) for r in "ua"]
        for name, price, r, row in moves:
            after = roles + (r or "")
            if not re.fullmatch("s?(ua)*u?", after):
                continue
            heapq.heappush(heap, (cost + price, audit + name, i + (name != "I"), after, out + ((row,) if row else ())))


def brute(rows):
    """rows: (conv_id, turn, role, text) after damage."""
    convs, out = {}, {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    for conv, items in convs.items():
        items.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()))
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in items:
            found = re.findall(SPACE, text)
            fault = "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault))
        turns = [r[1] for r in items if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, audit, repaired = cheapest(marked)
        text = "\n".join(f"{a}:{b}" for a, b in repaired)
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def sample(n, seed, longest=7):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 5 + ["system", "tool", None, ""])
            text = rng.choice(["Yes.", "No", f"Fine {turn}!", f"And {turn}", " \t", None, "ok? \n", "漢。", "Why?\x85"])
            rows.append((conv, turn if rng.random() < 0.9 else rng.choice([None, 3, turn + 9]), role, text))
    return rows


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("conv", "seg", "at", "symbol", "kind", "mark", "code")}).repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in C.repair(C.damaged(df), df, **options).collect()}
    want = brute(damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got == {r[0]: want.get(r[0], nothing) for r in rows}


def test_against_all_edit_sequences(spark):
    check(spark, sample(300, 1) + [(None, i, r, "Null conversation.") for i, r in enumerate(["user", "assistant", "user"])])


@pytest.mark.parametrize("segment", [1, 3])
def test_segments(spark, segment):
    check(spark, sample(60, 2, 12), segment=segment)


def test_segments_agree_on_long_conversations():
    rng = random.Random(3)
    for _ in range(60):
        symbols = np.repeat([rng.randrange(9) for _ in range(30)], [rng.choice([1, 1, 2, 5, 40]) for _ in range(30)])
        whole = C.unroll(symbols, C.END, (C.START,))[0]
        cuts = sorted(rng.sample(range(1, len(symbols)), 5))
        parts, after, state, audit = np.split(symbols, cuts), [C.END], C.START, ""
        for p in reversed(parts[1:]):
            after.append(C.advance(C.segment_matrix(p), after[-1]))
        for p, a in zip(parts, reversed(after)):
            found = C.unroll(p, a, (0, 1, 2, 3))
            audit += found[state][1]
            state = found[state][0]
        assert (state, audit) == whole
        assert C.power(4, 5) == C.segment_matrix(np.full(32, 4))


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello."), (1, 3, "assistant", "Again."), (2, 0, "assistant", "Alone.")]
    got = sorted(tuple(r) for r in C.repaired_rows(spark.createDataFrame(rows, SCHEMA), segment=2).collect())
    assert [g[1:] for g in got if g[0] == 1][:3] == [(0, "K", "system", "Be kind."), (1, "K", "user", "Hi."), (2, "K", "assistant", "Hello.")]
    for conv in (1, 2):
        roles = "".join(g[3][0] for g in got if g[0] == conv)
        assert re.fullmatch("(s?(ua)+)?", roles)


def test_empty_and_one_long(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repair(empty).collect() == [] and C.repaired_rows(empty).collect() == []
    rows = [(5, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(5000)] + [(6, 0, "user", "word " * 200_000 + ".")]
    (a, b) = sorted(C.repair(spark.createDataFrame(rows, SCHEMA), segment=64).collect())
    assert (a.cost, a.audit, a.illegal) == (0, "K" * 5000, 0) and (b.cost, b.audit) == (2, "KI")
