"""A Merkle manifest of a dataset, with proofs that are folded from retained hash states.

Leaves hash whole rows; in each tree of leaves (one per ``lang``) every FAN consecutive nodes become
one, until one is left, the subroot; the subroots grow one more tree to the root.

Trees are cut into blocks of FAN**LEVELS (4,096) consecutive nodes.  A block is one small group: a task
grows it, keeps for each parent a copy of the SHA-256 state before each child slot, and returns the top.  The
tops are the nodes of the next round, so a tree of n leaves takes log(n) / log(FAN**LEVELS) rounds.  On the way down
each node gets its path: the digests left and right of it, level by level.  A leaf is folded by resuming the
state of its slot with the replaced digest and the siblings to the right, in its block first, then along the path of the block.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import placed
from .store import written

FAN, LEVELS = 8, 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_PATH = "array<struct<`left`: string, `right`: string>>"


def leaf_digest(columns: list[Column]) -> Column:
    """H of a row's values, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


class Parent:
    """A node, with the hash state before each child slot."""

    __slots__ = ("children", "before", "digest")

    def __init__(self, children: list[bytes]):
        state, self.children, self.before = sha256(), children, []
        for child in children:
            self.before.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def siblings(self, slot: int) -> tuple[bytes, bytes]:
        return b"".join(self.children[:slot]), b"".join(self.children[slot + 1:])

    def fold(self, slot: int, digest: bytes) -> bytes:
        """The parent's digest with another child in ``slot``."""
        return resume(self.before[slot], digest, b"".join(self.children[slot + 1:]))


def resume(state, digest: bytes, right: bytes) -> bytes:
    state = state.copy()
    state.update(digest)
    state.update(right)
    return state.hexdigest().encode()


def depth(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    d = 0
    while FAN ** d < n:
        d += 1
    return d


def grow(nodes: list[bytes], levels: int) -> list[list[Parent]]:
    """The parents of a block, level by level."""
    out = []
    for _ in range(levels):
        out.append([Parent(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)])
        nodes = [p.digest for p in out[-1]]
    return out


def _block(table: pa.Table) -> tuple[pa.Table, list[bytes], list[list[Parent]]]:
    table = table.sort_by("at")
    nodes = [x.encode() for x in table.column("digest").to_pylist()]
    return table, nodes, grow(nodes, table.column("climb")[0].as_py())


def _top(table: pa.Table) -> pa.Table:
    table, nodes, levels = _block(table)
    return pa.table({
        "tree": table.column("tree").slice(0, 1), "at": table.column("block").slice(0, 1), "n": table.column("n").slice(0, 1),
        "digest": pa.array([(levels[-1][0].digest if levels else nodes[0]).decode()]),
    })


def _inside(levels: list[list[Parent]], i: int):
    """(parent, slot) of the i-th node of a block, level by level."""
    for parents in levels:
        i, slot = divmod(i, FAN)
        yield parents[i], slot


def _paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """Each node's path: inside its block, then the block's own."""
    nodes, _, levels = _block(nodes)
    rest = above.column("path")[0].as_py()
    paths = []
    for i in range(len(nodes)):
        sides = [p.siblings(slot) for p, slot in _inside(levels, i)]
        paths.append([{"left": a.decode(), "right": b.decode()} for a, b in sides] + rest)
    copies = lambda name: pa.array([above.column(name)[0].as_py()] * len(nodes))
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    return pa.table({"tree": nodes.column("tree"), "block": nodes.column("at"), "path": pa.array(paths, kind), "subroot": copies("subroot"), "root": copies("root")})


def _folds(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """Leaves of a block: proof, and the root folded from the tampered leaf."""
    nodes, _, levels = _block(nodes)
    path = [(x["left"].encode(), x["right"].encode()) for x in above.column("path")[0].as_py()]
    states = [sha256(left) for left, _ in path]          # of the block's slots, retained for all its leaves
    rest = b"".join(left + right for left, right in path)
    proofs, folded = [], []
    for i, digest in enumerate(nodes.column("tampered").to_pylist()):
        digest, proof = digest.encode(), sha256()
        for parent, slot in _inside(levels, i):
            for side in parent.siblings(slot):
                proof.update(side)
            digest = parent.fold(slot, digest)
        for state, (_, right) in zip(states, path):
            digest = resume(state, digest, right)
        proof.update(rest)
        proofs.append(proof.hexdigest())
        folded.append(digest.decode())
    copies = lambda name: pa.array([above.column(name)[0].as_py()] * len(nodes))
    return pa.table({
        "doc_id": nodes.column("doc_id"), "leaf": nodes.column("digest"), "subroot": copies("subroot"), "root": copies("root"),
        "proof_sha256": pa.array(proofs), "folded_root": pa.array(folded),
    })


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` with their block, and the levels that it climbs: ``levels``, or those up to the top of its tree."""
    climb = F.lit(levels)
    for d in range(levels - 1, -1, -1):
        climb = F.when(F.col("n") <= FAN ** d, d).otherwise(climb)
    return nodes.withColumns({"block": F.expr(f"at div {FAN ** levels}"), "climb": climb})


def _rounds(nodes: DataFrame, name: str, levels: int) -> list[DataFrame]:
    """``nodes`` (tree, at, n, digest, ..) in blocks, then the tops of each round, until one per tree is left."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    out = [_blocks(nodes, levels)]
    while True:
        blocks = out[-1].select("tree", "at", "n", "digest", "block", "climb").groupBy("tree", "block")
        tops = written(blocks.applyInArrow(_top, "tree string, at long, n long, digest string"), name)
        out.append(_blocks(tops.withColumn("n", F.expr(f"(n + {FAN ** levels - 1}) div {FAN ** levels}")), levels))
        if most <= FAN ** levels:
            return out
        most = -(-most // FAN ** levels)


def _down(rounds: list[DataFrame], paths: DataFrame, name: str) -> DataFrame:
    """Paths (tree, block, ..) of the blocks of the first round, from those of the last."""
    for nodes in reversed(rounds[1:-1]):
        pairs = nodes.groupBy("tree", "block").cogroup(paths.groupBy("tree", "block"))
        paths = written(pairs.applyInArrow(_paths, f"tree string, block long, path {_PATH}, subroot string, root string"), name)
    return paths


def _counted(rows: DataFrame) -> DataFrame:
    """``rows`` with ``n``, the rows of their tree."""
    return rows.join(rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "tree")


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered`` is the text as someone else has it (default: unchanged); folded_root is the root folded from
    the leaf with that text and the original siblings, and verified says that it is the root.  Leaves of
    equal lang and doc_id are ordered by their digest (null doc_ids first), so repeated rows and ties have a defined tree.
    A block has FAN**``levels`` nodes.
    Nulls and empty texts hash as in :func:`leaf_digest`.  An empty table gives an empty result; other columns are ignored.
    """
    values = {c: F.col(c) for c in COLUMNS}
    other = values | {"text": F.col("text").cast("string") if tampered is None else tampered}
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(list(values.values())).alias("digest"), leaf_digest(list(other.values())).alias("tampered"),
    )
    leaves = _counted(placed(leaves, "tree", ["doc_id", "digest"], "leaves"))
    rounds = _rounds(leaves, "tops", levels)
    subroots = rounds[-1].select(F.lit("roots").alias("tree"), F.col("tree").alias("lang_tree"), "digest")
    crown = _counted(placed(subroots, "tree", ["lang_tree"], "subroots"))
    crowns = _rounds(crown, "crown", levels)
    root = crowns[-1].select("tree", F.col("at").alias("block"), F.expr(f"cast(array() as {_PATH})").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    paths = _down([crowns[0], *crowns], root, "crown_paths")             # of the subroots themselves
    paths = paths.withColumnRenamed("block", "at").drop("subroot").join(
        crown.select("tree", "at", F.col("lang_tree"), F.col("digest").alias("subroot")), ["tree", "at"])
    paths = written(paths.select(F.col("lang_tree").alias("tree"), F.lit(0).cast("long").alias("block"), "path", "subroot", "root"), "subroot_paths")
    paths = _down(rounds, paths, "paths")
    pairs = rounds[0].groupBy("tree", "block").cogroup(paths.groupBy("tree", "block"))
    out = pairs.applyInArrow(_folds, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_cased(every: int = 3) -> Column:
    """The text of ``docs`` with A-Z lower-cased where ``every`` divides the crc32 of the decimal doc_id."""
    text = F.col("text").cast("string")
    hit = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % every == 0
    return F.when(hit, F.translate(text, UPPER, LOWER)).otherwise(text)
