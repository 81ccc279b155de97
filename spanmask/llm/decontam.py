"""Benchmark decontamination by spaced seeds.

An overlap is a run of ``SPAN`` (12) words of a document and of a benchmark item, word for
word side by side, of which at most two differ.  Six fixed masks of span 12 each keep two
residues of the position modulo 4 and ignore the other six positions; any two positions are
ignored together by some mask, so every overlap is hit by a seed: nothing is sampled or missed.
Shorter items are looked for as a whole.  With 8 to 11 words one word may differ: two masks of the item's length keep every
other position, and any position is ignored by one of them.  With 5 to 7 words none may differ (one mask of their length that
keeps all).  An item of fewer words must be the whole document.

The benchmark's seeds set bits in a filter whose size is bounded by a parameter and that is
sent to the tasks.  Documents are read once; a position whose seed passes the filter goes on
as one small row with the hashes of its 12 words, joins the benchmark's seeds, and is compared
word by word there.  All windows with at most two differences are found this way, so the
overlaps are put together from them alone, one diagonal (a document, an item and the distance of their positions) at a time:
a diagonal has at most as many windows as the item has words.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written
from .text import blocks, find_words, lists, mix, range_hash, window_hash

U64 = np.uint64
SPAN, DIFFER = 12, 2
#: Items from this many words on may have one differing word, from SHORTEST on none; below they must be a whole text.
SOFT, SHORTEST = 8, 5
#: Positions of a 12-word window that each mask compares.
MASKS = tuple(tuple(p for p in range(SPAN) if p % 4 in kept) for kept in combinations(range(4), 2))
_FACTOR = mix(np.arange(1, SPAN + 1, dtype=np.uint64), 11) | U64(1)
#: Bits of the seed filter at most (2**27: 16 MB); a larger benchmark only lets more documents through to the join.
FILTER_BITS = 27


def spaced(codes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """One hash per mask of the 12 words from each position in ``first``."""
    part = [sum(codes[first + p] * _FACTOR[p] for p in range(r, SPAN, 4)) for r in range(4)]
    return [mix(part[a] + part[b], 20 + i) for i, (a, b) in enumerate(combinations(range(4), 2))]


def _items(batches):
    for part, data, offsets in blocks(batches, "text"):
        words = find_words(data, offsets, lower=True)
        yield pa.RecordBatch.from_pydict({
            "item_id": part.column("item_id"), "n": words.counts,
            "codes": lists(words.code.view(np.int64), words.counts),
            "mark": mix(range_hash(words.code, words.ptr[:-1], words.ptr[1:])).view(np.int64),
        })


def _windows(codes: np.ndarray, first: np.ndarray, n: int = SPAN) -> pa.ListArray:
    """32-bit hashes of the n words from each position."""
    words = codes.astype(np.uint32).view(np.int32)[first[:, None] + np.arange(n)]
    return lists(words.reshape(-1), np.full(len(first), n))


def allowed(n: int) -> int:
    """Words of an overlap with an item of n words that may differ."""
    return DIFFER if n >= SPAN else int(n >= SOFT)


def short_seeds(codes: np.ndarray, first: np.ndarray, n: int, whole: bool) -> list[np.ndarray]:
    """One hash per mask of an item of n < SPAN words, for the n words from each position; ``whole`` ones are a kind of their own."""
    if allowed(n):
        part = [sum(codes[first + p] * _FACTOR[p] for p in range(r, n, 2)) for r in range(2)]
        return [mix(part[r], 40 + 2 * n + r) for r in range(2)]
    return [mix(window_hash(codes, first, n), 80 + whole)]


def _item_seeds(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            codes = batch.column("codes")[i].values.to_numpy().view(np.uint64)
            n = len(codes)
            first = np.arange(max(n - SPAN, 0) + 1)
            seeds = spaced(codes, first) if n >= SPAN else short_seeds(codes, first, n, n < SHORTEST)
            hashes, at = np.concatenate(seeds), np.tile(first, len(seeds))
            yield pa.RecordBatch.from_pydict({
                "seed": hashes.view(np.int64), "item_id": pa.array([batch.column("item_id")[i].as_py()] * len(at), pa.int64()),
                "item_at": at.astype(np.int32), "item_window": _windows(codes, at, min(n, SPAN)),
            })


def _in_filter(bits: np.ndarray, mask: int, h: np.ndarray) -> np.ndarray:
    a, b = h & U64(mask), (h >> U64(32)) & U64(mask)
    ok = (bits[a >> U64(6)] >> (a & U64(63))) & U64(1) == 1
    at = np.flatnonzero(ok)
    b = b[at]
    ok[at] = (bits[b >> U64(6)] >> (b & U64(63))) & U64(1) == 1
    return ok


def _scan(shared, mask: int, lengths: tuple[int, ...]):
    """Per position with a seed in the filter: doc_id, mark of the text, place, seeds, hashes of its 12 words."""
    def run(batches):
        bits = shared.value
        for part, data, offsets in blocks(batches, "text"):
            words = find_words(data, offsets, lower=True)
            mark = mix(range_hash(words.code, words.ptr[:-1], words.ptr[1:])).view(np.int64)

            def rows(seeds, counts, first, doc, window):
                return pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").take(pa.array(doc)), "mark": mark[doc], "at": (first - words.ptr[doc]).astype(np.int32),
                    "seeds": lists(seeds.view(np.int64), counts), "window": window,
                })

            for n in (SPAN, *lengths):
                first, doc = words.windows(n)
                if n < SHORTEST:                         # the whole document
                    whole = words.counts[doc] == n
                    first, doc = first[whole], doc[whole]
                if not len(first):
                    continue
                found = spaced(words.code, first) if n == SPAN else short_seeds(words.code, first, n, n < SHORTEST)
                seeds = np.stack(found, axis=1)
                ok = _in_filter(bits, mask, seeds.reshape(-1)).reshape(seeds.shape)
                some = np.flatnonzero(ok.any(axis=1))
                yield rows(seeds[some][ok[some]], ok[some].sum(axis=1), first[some], doc[some], _windows(words.code, first[some], n))

    return run


def longest(windows: list[dict], n: int) -> tuple[int, int, int]:
    """(item position, words, equal words) of the longest overlap on one diagonal with an item of ``n`` words.

    Windows that overlap or touch make one overlap.  ``equal`` has bit i set if word i of the window is equal.
    """
    need, best = min(SPAN, n), None
    rows = sorted((w["item_at"], w["equal"]) for w in windows)
    at = 0
    while at < len(rows):
        start, _ = rows[at]
        end, same = start, set()
        while at < len(rows) and rows[at][0] <= max(end, start):
            place, equal = rows[at]
            end = place + need
            same.update(place + i for i in range(need) if equal >> i & 1)
            at += 1
        found = (end - start, len(same), -start)
        best = max(best or found, found)
    words, equal, item = best
    return -item, words, equal


def _longest(batches):
    for batch in batches:
        found = [longest(w, n) for w, n in zip(batch.column("windows").to_pylist(), batch.column("n").to_pylist())]
        item, words, equal = zip(*found) if found else ((),) * 3
        diagonal = batch.column("diagonal").to_pylist()
        columns = ([d + i for d, i in zip(diagonal, item)], item, words, equal)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("item_id"), *(pa.array(c, pa.int64()) for c in columns)],
            ["doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal"],
        )


def leaks(docs: DataFrame, benchmark: DataFrame, *, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, n_words, n_equal): the longest verified overlap of each
    document (doc_id, text) and benchmark item (item_id, text) that have one; starts and lengths in words.

    Words compare with A-Z lower-cased.  Items with equal words are one, named by the smallest item_id.
    Null, empty and word-free texts and items, and rows with a null doc_id or item_id give no row.
    Rows that share a doc_id each count for it, with the longest overlap.  Other columns are ignored.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, doc_start long, item_start long, n_words long, n_equal long"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = (
        items.where("item_id is not null and text is not null").mapInArrow(_items, "item_id long, n long, codes array<long>, mark long")
        .where("n > 0").groupBy("mark", "n").agg(F.min("item_id").alias("item_id"), F.first("codes").alias("codes"))
    )
    items = written(items.select("item_id", "n", "codes"), "items")
    seeds = written(items.mapInArrow(_item_seeds, "seed long, item_id long, item_at int, item_window array<int>"), "item_seeds")
    total = seeds.count()
    if total == 0:
        return spark.createDataFrame([], schema)
    lengths = tuple(sorted(r["n"] for r in items.where(F.col("n") < SPAN).select("n").distinct().collect()))
    size = min(filter_bits, max(12, (total * 64 - 1).bit_length()))
    mask = (1 << size) - 1
    place = F.explode(F.array(F.col("seed").bitwiseAND(mask), F.shiftrightunsigned("seed", 32).bitwiseAND(mask)))
    cells = (
        seeds.select(place.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")).toPandas()
    )
    bits = np.zeros(1 << (size - 6), dtype=np.uint64)
    bits[cells["cell"].to_numpy()] = cells["bits"].to_numpy().view(np.uint64)

    hits = docs.mapInArrow(_scan(spark.sparkContext.broadcast(bits), mask, lengths), "doc_id long, mark long, at int, seeds array<long>, window array<int>")
    met = hits.select("doc_id", "mark", "at", "window", F.explode("seeds").alias("seed")).join(seeds, "seed")
    same = F.zip_with("window", "item_window", lambda a, b: (a == b).cast("int"))
    equal = F.aggregate(F.reverse(same), F.lit(0), lambda bits, x: bits * 2 + x)
    size_ = F.size("item_window")
    differ = F.when(size_ >= SPAN, DIFFER).otherwise((size_ >= SOFT).cast("int"))
    good = met.where(F.size("window") == size_).withColumn("equal", equal).where(F.bit_count("equal") >= size_ - differ)
    found = (
        good.groupBy("doc_id", "mark", "item_id", (F.col("at") - F.col("item_at")).cast("long").alias("diagonal"))
        .agg(F.collect_set(F.struct("item_at", "equal")).alias("windows"))
        .join(items.select("item_id", "n"), "item_id").select("doc_id", "item_id", "n", "diagonal", "windows").mapInArrow(_longest, schema)
    )
    best = F.max(F.struct("n_words", "n_equal", -F.col("doc_start"), -F.col("item_start"))).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("b.col3")).alias("doc_start"), (-F.col("b.col4")).alias("item_start"), F.col("b.n_words").alias("n_words"), F.col("b.n_equal").alias("n_equal")
    )
