import hashlib
import random
import zlib

from pyspark.sql import functions as F

from spanmask.llm import merkle
from spanmask.llm.merkle import lower_cased, manifest


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def walk(tree, i, digest):
    """(siblings, root folded from digest)."""
    siblings = []
    for nodes in tree[:-1]:
        run = nodes[i // 8 * 8:i // 8 * 8 + 8]
        siblings += run[:i % 8] + run[i % 8 + 1:]
        digest = h(run[:i % 8] + [digest] + run[i % 8 + 1:])
        i //= 8
    return siblings, digest


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {x: levels([t[2] for t in sorted(trees[x], key=lambda t: t[:3])]) for x in langs}
    top = levels([built[x][-1][0] for x in langs])
    out = []
    for j, x in enumerate(langs):
        for i, (_, _, digest, r) in enumerate(sorted(trees[x], key=lambda t: t[:3])):
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            inner, folded = walk(built[x], i, leaf((*r[:4], text)))
            outer, folded = walk(top, j, folded)
            out.append((r[0], digest, built[x][-1][0], top[-1][0], h(inner + outer), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(3) for c in ("tree", "at", "n", "block", "path", "leaf", "root")}).repartition(3)
    got = sorted((tuple(r) for r in manifest(df, lower_cased(), **options).collect()), key=repr)
    assert got == brute(rows)


def sample(n, langs, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", None, "b:1"]), rng.choice(langs), rng.choice([None, i]), rng.choice([None, "", f"Text {i} é漢", "small"])) for i in range(n)]
    rng.shuffle(rows)
    return rows


def test_several_rounds(spark):
    check(spark, sample(700, ["en", "en", "en", "de", None]) + sample(70, [f"l{i}" for i in range(20)], 4), levels=1)


def test_rows_against_brute_force(spark):
    check(spark, sample(700, ["en", "de", None, ""]) + [(None, None, None, None, None)] * 3 + [(5, "s", "en", 1, "Twice")] * 2)
    check(spark, sample(40, [f"l{i}" for i in range(30)], 2))
    for n in (1, 2, 8, 9):
        check(spark, sample(n, ["en"], n))


def test_more_than_a_block(spark):
    check(spark, sample(9001, ["en", "en", "en", "de"], 3))


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = manifest(df, lower_cased())
    assert out.collect() == [] and out.columns[:3] == ["doc_id", "leaf", "subroot"]


def test_parent_resumes_its_states():
    children = [h([str(i)]).encode() for i in range(8)]
    parent = merkle.Parent(children)
    other = h(["x"]).encode()
    for slot in range(8):
        want = hashlib.sha256(b"".join(children[:slot] + [other] + children[slot + 1:])).hexdigest().encode()
        assert parent.fold(slot, other) == want and parent.fold(slot, children[slot]) == parent.digest
    assert [merkle.depth(n) for n in (0, 1, 2, 8, 9, 64, 65)] == [0, 0, 1, 1, 2, 2, 3]
