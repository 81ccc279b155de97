"""Packing token sequences: shortest-pack-first over the length histogram.

Documents are cut at the sequence length; the pieces' lengths make a histogram of at most
``size`` bins, the only thing that reaches the driver.  Lengths are placed from the
longest to the shortest, each into the least filled pattern that has room; a pattern stands
for ``count`` equal packs and splits when fewer pieces than packs are left.  Every piece then
finds its place by its rank among the pieces of its length: the ranks of a length are dealt
to the slots of the patterns that use it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import written
from .text import blocks
from .tokens import encoder

#: Pieces that one window task ranks, on average.
RANKED = 50_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def patterns(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """(packs, lengths in a pack): every length is used as often as the histogram says.

    A length goes to the emptiest patterns first; where several copies fit in
    the same pack, they are placed one at a time, so that packs fill evenly.
    """
    open_: dict[int, list[tuple[int, tuple[int, ...]]]] = {}    # free room -> patterns
    rooms: list[int] = []
    done: list[tuple[int, tuple[int, ...]]] = []

    def put(count, pack, room):
        if room == 0:
            done.append((count, pack))
        else:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((count, pack))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = rooms[-1] if rooms else 0                    # the shortest pack has the most room
            if room < length:
                put(left, (length,), size - length)
                break
            count, pack = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(bisect_left(rooms, room))
            used = min(count, left)
            put(used, (*pack, length), room - length)
            if count > used:
                put(count - used, pack, room)
            left -= used
    for room in rooms:
        done += open_[room]
    return done


class Slots:
    """For each length, in rank order: runs of ranks and where they go."""

    def __init__(self, packs: list[tuple[int, tuple[int, ...]]], first: int = 0):
        runs: dict[int, list[tuple[int, int, int]]] = {}
        for count, pack in packs:
            offset = 0
            for length in pack:
                runs.setdefault(length, []).append((count, first, offset))
                offset += length
            first += count
        self.sequences = first
        self.runs = {}
        for length, x in runs.items():
            a = np.array(x, dtype=np.int64)
            self.runs[length] = (np.cumsum(a[:, 0]) - a[:, 0], a[:, 1], a[:, 2])

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these lengths and ranks."""
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for at in np.split(order, cuts) if len(order) else []:
            low, seq, off = self.runs[int(length[at[0]])]
            run = np.searchsorted(low, rank[at], side="right") - 1
            sequence[at], offset[at] = seq[run] + rank[at] - low[run], off[run]
        return sequence, offset


def _pieces(path: str, size: int, end: int, keep_ids: bool):
    def run(batches):
        enc = encoder(path)
        for part, data, offsets in blocks(batches, "text"):
            ids, counts = enc.encode(data, offsets, end)
            n = -(-counts // size)
            doc = np.repeat(np.arange(len(counts)), n)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = nth * size
            length = np.minimum(counts[doc] - start, size)
            at = (np.cumsum(counts) - counts)[doc] + start
            raw = ids.astype("<u4")
            out = {
                "doc_id": part.column("doc_id").take(pa.array(doc)),
                "start": start,
                "length": length,
                "ids_crc32": np.fromiter((zlib.crc32(raw[a:a + k]) for a, k in zip(at.tolist(), length.tolist())), np.int64, len(at)),
                "doc_tokens": counts[doc],
            }
            if keep_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(np.append(at, len(raw)).astype(np.int32)), pa.array(raw.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(out)

    return run


def _placed(slots: Slots):
    def run(batches):
        for batch in batches:
            sequence, offset = slots.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return run


def pack_lengths(pieces: DataFrame, size: int, *, order: tuple[str, ...]) -> DataFrame:
    """The rows of ``pieces`` (a table that gives the same rows each time, with ``length`` from 1 to
    ``size``) and for each its ``sequence_id`` and ``offset``.  ``order`` names columns that tell rows apart."""
    total = pieces.count()
    salts = max(1, -(-total // RANKED))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(
        "length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before")
    )
    slots = Slots(patterns({r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}, size))
    ranked = (
        salted.withColumn("nth", F.row_number().over(Window.partitionBy("length", "salt").orderBy(*order)))
        .join(before, ["length", "salt"])
        .select(*pieces.columns, (F.col("before") + F.col("nth") - 1).alias("rank"))
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(_placed(slots), f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, *, size: int = 2048, end: int = 1, keep_ids: bool = False) -> DataFrame:
    """Per piece of each document (doc_id, text): start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids and the end id; null and empty texts are the end id alone.  With
    ``keep_ids`` the ids themselves follow as ``ids array<int>``.  Rows with a null or repeated doc_id
    are packed like any other.  Other columns are ignored.  An empty table gives no pieces.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = PIECES + (", ids array<int>" if keep_ids else "")
    pieces = written(docs.mapInArrow(_pieces(tokenizer, size, end, keep_ids), schema), "pieces")
    return pack_lengths(pieces, size, order=("doc_id", "start", "ids_crc32"))
