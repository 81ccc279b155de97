"""MinHash near-duplicates: fast similarity sketches, banding, verification on full sets.

Documents are sets of word shingles.  A sketch has ``bands * rows``
coordinates that are filled in rounds: in the first half of the rounds each
shingle falls into one hashed bin, in round ``r`` of the second half all shingles
fall into bin ``r``, so that every bin is filled at the latest then; a bin keeps the
smallest (round, hash) that it saw.  Two sets agree on a coordinate with probability
equal to their similarity, with the concentration of a full MinHash, and a large set is
done after one or two rounds.

Equal sets are folded into one class first (a group of exact copies costs one row
afterwards).  Classes that share a band are candidates:

1. every class is compared with one leader, the smallest class of the bucket it
   shares most bands with.  One hot bucket costs one comparison per member;
2. what is left are classes in buckets whose members lie in several components by then, such as pages of one template that
   are alike but not alike enough.  To compare them all would be a square of the family.  Sets of similarity ``t`` share some of their rarest
   shingles, whatever the order of rarity: of a set of n shingles the first ``n - ceil(t n) + 4`` are filed, and two
   similar sets meet under 4 of them at least.  Pages of a template have the template's shingles last, so they do not meet.
   Rarity is an estimate from a table of counts of bounded size; the same order for all sets is all that it takes to miss nothing.
   Classes that meet none of another component often enough leave their buckets.  Of those that remain, the members
   outside the largest component are compared with all members, in blocks of a bounded number of
   classes; only links that join two components leave a block.

All comparisons are on the whole shingle sets.  With the defaults a pair at
exactly the threshold of 0.85 is missed by all 24 bands with probability below 1e-6.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import written
from .text import blocks, find_words, lists, mix, range_hash, ragged, sums

U64 = np.uint64
BANDS, ROWS = 24, 5
#: Classes in a block of step 2: a task compares two blocks at most.
BLOCK = 256
#: Rare shingles that two similar sets share at least.
MEETINGS = 4
#: Cells of the table that estimates how rare a shingle is (2**16: 0.5 MB).  Template shingles stand out of the T shingles
#: counted when their family is larger than some sqrt(T / cells).
COUNT_BITS = 16


def shingle_sets(words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, ptr): the set of document i is hashes[ptr[i]:ptr[i+1]], ascending.

    A document with fewer than k words, but some, has its whole sequence as only shingle.
    """
    n = words.counts
    short = (n > 0) & (n < k)
    per = np.where(short, 1, np.maximum(n - k + 1, 0))
    first = ragged(words.ptr[:-1], per)
    size = np.repeat(np.where(short, n, k), per)
    code = range_hash(words.code, first, first + size)
    code = mix(code + size.astype(np.uint64))
    doc = np.repeat(np.arange(len(n)), per)
    order = np.lexsort((code, doc))
    code, doc = code[order], doc[order]
    new = np.ones(len(code), dtype=bool)
    new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    code, doc = code[new], doc[new]
    return code, np.searchsorted(doc, np.arange(len(n) + 1))


def sketch(code: np.ndarray, ptr: np.ndarray, size: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``size`` coordinates per document (empty sets: all ones)."""
    docs = len(ptr) - 1
    out = np.full((docs, size), ~U64(0))
    flat = out.reshape(-1)
    open_ = np.diff(ptr) > 0
    live, doc = code, np.repeat(np.arange(docs), np.diff(ptr))
    for r in range(2 * size):
        h = mix(live, r + 1)
        if r < size:
            bin_ = ((h >> U64(32)) * U64(size) >> U64(32)).astype(np.int64)
        else:
            bin_ = np.full(len(live), r - size)
        value = (h & U64(0xFFFFFFFF)) | U64(r) << U64(32)
        np.minimum.at(flat, doc * size + bin_, value)
        still = open_ & (out == ~U64(0)).any(axis=1)
        if not still.any():
            break
        if still.sum() < open_.sum():
            keep = still[doc]
            live, doc, open_ = live[keep], doc[keep], still
    return out


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per document and band; the band's number is part of the key."""
    c = coordinates.reshape(len(coordinates), bands, rows)
    key = np.zeros((len(c), bands), dtype=np.uint64)
    for j in range(rows):
        key = mix(key ^ c[:, :, j], j + 1)
    return mix(key + np.arange(bands, dtype=np.uint64)[None, :] * U64(0x9E3779B97F4A7C15))


def _signatures(k: int, bands: int, rows: int):
    def run(batches):
        for part, data, offsets in blocks(batches, "text"):
            code, ptr = shingle_sets(find_words(data, offsets, lower=True), k)
            n = np.diff(ptr)
            keys = band_keys(sketch(code, ptr, bands * rows), bands, rows)[n > 0].reshape(-1)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"),
                "n_shingles": n,
                "set_a": sums(mix(code, 101), ptr).view(np.int64),
                "set_b": sums(mix(code, 102), ptr).view(np.int64),
                "keys": lists(keys.view(np.int64), np.where(n > 0, bands, 0)),
            })

    return run


def _similar(inter, a, b, num: int, den: int):
    return den * inter >= num * (a + b - inter)


def _verified(k: int, num: int, den: int):
    """Keep the rows of (text, other text) whose sets are similar."""
    def run(batches):
        for part, data, offsets in blocks(batches, "text"):
            a, pa_ = shingle_sets(find_words(data, offsets, lower=True), k)
            ok = np.zeros(part.num_rows, dtype=bool)
            at = 0
            for sub, other, where in blocks([part], "leader_text"):
                b, pb = shingle_sets(find_words(other, where, lower=True), k)
                m = sub.num_rows
                mine = a[pa_[at]:pa_[at + m]]
                na, nb = np.diff(pa_[at:at + m + 1]), np.diff(pb)
                row = np.concatenate([np.repeat(np.arange(m), na), np.repeat(np.arange(m), nb)])
                both = np.concatenate([mine, b])
                order = np.lexsort((both, row))
                row, both = row[order], both[order]
                same = (both[1:] == both[:-1]) & (row[1:] == row[:-1])
                inter = np.bincount(row[1:][same], minlength=m)
                ok[at:at + m] = _similar(inter, na, nb, num, den)
                at += m
            yield pa.RecordBatch.from_pydict({"a": part.column("a").filter(pa.array(ok)), "b": part.column("b").filter(pa.array(ok))})

    return run


def _cells(code: np.ndarray) -> np.ndarray:
    return (mix(code, 203) >> U64(64 - COUNT_BITS)).astype(np.int64)


def _counts(k: int):
    """(cell, n): how often the shingles of a cell stand in the sets."""
    def run(batches):
        for _, data, offsets in blocks(batches, "text"):
            code, _ = shingle_sets(find_words(data, offsets, lower=True), k)
            cell, n = np.unique(_cells(code), return_counts=True)
            yield pa.RecordBatch.from_pydict({"cell": cell, "n": n.astype(np.int64)})

    return run


def _least(n, num: int, den: int):
    """Shingles that a set of n shares at least with a similar one."""
    return -(-n * num // den)


def _rarest(k: int, num: int, den: int, shared):
    """(shingle, doc_id, component, n): the shingles under which each set is filed."""
    def run(batches):
        counts = shared.value
        for part, data, offsets in blocks(batches, "text"):
            code, ptr = shingle_sets(find_words(data, offsets, lower=True), k)
            n = np.diff(ptr)
            doc = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((code, counts[_cells(code)], doc))
            place = np.arange(len(code)) - np.repeat(ptr[:-1], n)
            least = _least(n, num, den)
            filed = n - least + np.minimum(MEETINGS, least)
            # Rows that share a doc_id: a text that is not of this class.
            own = (n == part.column("n").to_numpy()) & (sums(mix(code, 101), ptr).view(np.int64) == part.column("set_a").to_numpy())
            take = (place < filed[doc]) & own[doc]
            doc = doc[take]
            yield pa.RecordBatch.from_pydict({
                "shingle": code[order][take].view(np.int64), "doc_id": part.column("doc_id").take(pa.array(doc)),
                "component": part.column("component").take(pa.array(doc)), "n": n[doc].astype(np.int64),
            })

    return run


def _block_links(k: int, num: int, den: int):
    """Links between the components that meet in a block; a spanning set of them."""
    def one(ids, comps, texts):
        column = pa.array(texts, type=pa.large_string())
        codes, owner, at = [], [], 0
        sizes = np.zeros(len(ids), dtype=np.int64)
        for part, data, offsets in blocks([pa.RecordBatch.from_arrays([column], ["text"])], "text"):
            code, ptr = shingle_sets(find_words(data, offsets, lower=True), k)
            sizes[at:at + part.num_rows] = np.diff(ptr)
            codes.append(code)
            owner.append(np.repeat(np.arange(at, at + part.num_rows), np.diff(ptr)))
            at += part.num_rows
        code, owner = np.concatenate(codes), np.concatenate(owner)
        values, index, count = np.unique(code, return_inverse=True, return_counts=True)
        shared = count[index] > 1
        index, owner = (np.cumsum(count > 1) - 1)[index[shared]], owner[shared]
        order = np.argsort(index, kind="stable")
        index, owner = index[order], owner[order]
        inter = np.zeros((len(ids), len(ids)), dtype=np.float64)
        rows, at = int(index[-1]) + 1 if len(index) else 0, 0
        while at < rows:                      # shared shingles x documents, in slices of bounded size
            to = min(rows, at + max(1, (4 << 20) // len(ids)))
            lo, hi = np.searchsorted(index, [at, to])
            grid = np.zeros((to - at, len(ids)), dtype=np.float32)
            grid[index[lo:hi] - at, owner[lo:hi]] = 1
            inter += grid.T @ grid
            at = to
        linked = _similar(inter, sizes[:, None], sizes[None, :], num, den) & (inter > 0)
        linked &= comps[:, None] != comps[None, :]
        parent = {}

        def root(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        for i, j in zip(*np.nonzero(np.triu(linked))):
            x, y = root(comps[i]), root(comps[j])
            if x != y:
                parent[max(x, y)] = min(x, y)
                yield ids[i], ids[j]

    def run(batches):
        for batch in batches:
            found = []
            for row in range(batch.num_rows):
                members = batch.column("members")[row].values
                found += one(members.field("doc_id").to_numpy(), members.field("component").to_numpy(), members.field("text").to_pylist())
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def near_duplicates(
    docs: DataFrame, *, shingle: int = 5, num: int = 85, den: int = 100, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_shingles, component_id and kept.

    Linked are documents with ``den * |A and B| >= num * |A or B|``.  component_id is the smallest
    doc_id reachable over links, itself included; kept is ``doc_id = component_id``.
    Null, empty and word-free texts have an empty set and no link.  A row with a null
    doc_id links with nothing, has a null component_id and is kept.  Rows that share a
    doc_id are one document: a link of any of them holds for all.  Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = written(
        docs.mapInArrow(_signatures(shingle, bands, rows), "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>"),
        "signatures",
    )
    sets = marks.where("n_shingles > 0 and doc_id is not null")
    classes = sets.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("doc_id"), F.min("keys").alias("keys"))
    classes = written(classes.select("doc_id", F.col("n_shingles").alias("n"), "set_a", "set_b", "keys"), "classes")
    copies = (
        sets.select("doc_id", "set_a", "set_b", F.col("n_shingles").alias("n"))
        .join(classes.select(F.col("doc_id").alias("first"), "set_a", "set_b", "n"), ["set_a", "set_b", "n"])
        .where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    )

    members = classes.select("doc_id", "n", F.explode("keys").alias("key"))
    buckets = written(members.groupBy("key").agg(
        F.min("doc_id").alias("leader"), F.min_by("n", "doc_id").alias("leader_n"), F.max("doc_id").alias("last"),
    ).where("leader <> last").drop("last"), "leaders")
    # (bucket, member) for buckets of two and more
    met = written(members.join(buckets, "key").select("key", "doc_id", "n", "leader", "leader_n"), "buckets")

    texts = docs.where("doc_id is not null")
    best = (
        met.where("doc_id <> leader").where(F.least("n", "leader_n") * den >= F.greatest("n", "leader_n") * num)
        .groupBy("doc_id", "leader").agg(F.count(F.lit(1)).alias("shared"))
        .groupBy("doc_id").agg(F.max_by("leader", F.struct("shared", -F.col("leader"))).alias("leader"))
    )
    pairs = (
        best.select(F.col("doc_id").alias("a"), F.col("leader").alias("b"))
        .join(texts.select(F.col("doc_id").alias("a"), "text"), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("leader_text")), "b")
        .select("a", "b", "text", "leader_text")
    )
    first = written(pairs.mapInArrow(_verified(shingle, num, den), "a long, b long").unionByName(copies), "first_links")
    label = components(first)

    placed = (
        met.join(label.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
    )
    mixed = placed.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("key")
    doubtful = placed.join(written(mixed, "mixed"), "key", "left_semi").select("doc_id", "component").distinct()
    doubtful = written(doubtful.join(classes.select("doc_id", "n", "set_a"), "doc_id").join(texts, "doc_id"), "doubtful")
    cells = doubtful.mapInArrow(_counts(shingle), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << COUNT_BITS, dtype=np.int64)
    counts[cells["cell"].to_numpy(dtype=np.int64)] = cells["n"].to_numpy(dtype=np.int64)
    filed = written(
        doubtful.mapInArrow(_rarest(shingle, num, den, docs.sparkSession.sparkContext.broadcast(counts)), "shingle long, doc_id long, component long, n long"), "filed")
    groups = filed.groupBy("shingle").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("shingle")
    # Classes that may have a partner in another component; the rest of a family leaves its buckets.
    least = F.ceil(F.col("n") * num / den)
    meeting = filed.join(written(groups, "shingles"), "shingle", "left_semi").groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("met"))
    open_ = written(meeting.where(F.col("met") >= F.least(F.lit(MEETINGS), least)).select("doc_id").distinct(), "open")
    placed = written(placed.select("key", "doc_id", "component").join(open_, "doc_id", "left_semi"), "placed")
    parts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"), F.expr("bit_xor(xxhash64(doc_id))").alias("mark"))
    # One row per set of members instead of one per band.
    mixed = (
        parts.groupBy("key").agg(
            F.count(F.lit(1)).alias("components"), F.max(F.struct("c", "component")).alias("most"), F.sum("c").alias("size"), F.expr("bit_xor(mark)").alias("mark"),
        ).where("components > 1")
        .groupBy("size", "mark").agg(F.min(F.struct("key", "most")).alias("b"))
        .select("b.key", F.col("b.most.component").alias("most"), F.ceil(F.col("size") / block).alias("alls"), F.ceil((F.col("size") - F.col("b.most.c")) / block).alias("others"))
    )
    mixed = written(mixed, "mixed_open")
    # Members outside the bucket's largest component meet all members; that component's own pairs need no look.
    own = lambda n: F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col(n))
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    cells = F.array_distinct(F.concat(
        F.transform(numbers("others"), lambda i: F.struct(i.alias("i"), own("alls").alias("j"))),
        F.when(F.col("component") != F.col("most"), F.transform(numbers("alls"), lambda j: F.struct(own("others").alias("i"), j.alias("j")))).otherwise(F.array()),
    ))
    spread = placed.join(mixed, "key").select("key", "doc_id", "component", F.inline(cells))
    met_blocks = (
        spread.join(texts, "doc_id").groupBy("key", "i", "j")
        .agg(F.collect_list(F.struct("doc_id", "component", "text")).alias("members"), F.min("component").alias("least"), F.max("component").alias("most"))
        .where("least <> most").select("members")
    )
    second = met_blocks.mapInArrow(_block_links(shingle, num, den), "a long, b long")
    # A second link joins two components of the first links.
    at = label.select("node", "component")
    lifted = (
        second.join(at.toDF("a", "ca"), "a", "left").join(at.toDF("b", "cb"), "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    )
    top = components(lifted)
    final = (
        label.join(top.toDF("component", "top"), "component", "left").select("node", F.coalesce("top", "component").alias("component"))
        .unionByName(top.join(label.select("node"), "node", "left_anti"))
    )
    return (
        marks.select("doc_id", "n_shingles")
        .join(final.select(F.col("node").alias("doc_id"), F.col("component").alias("component_id")), "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
