"""Repeated token spans: de Bruijn paths compacted by joins, then cut from the later documents.

Edges of the graph are the windows of ``span`` consecutive words.  Writing all of them
out would move the corpus several times over, so they travel in paths: consecutive windows
of a document whose smallest ``kmer``-word hash is the same k-mer at the same place
form one path, and that k-mer is the node at which the path is filed.  Equal windows have
the same node, wherever they stand, so:

* a node seen in one document only is not repeated and is dropped;
* a node whose paths are all equal does not branch: it compacts to one row with its first
  document as source, and all its windows repeat;
* at a branching node the *different* paths (not their copies) are opened into
  windows at one source coordinate each (document, first word), and a window's source is the
  smallest document that has it.

The spans of a document that have an earlier source are joined back by its id; windows
that overlap or touch become one long span.  Equality means equal 64-bit node and
64-bit path (or window) hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written
from .text import blocks, find_words, mix, ragged, range_hash, sums, window_hash

U64 = np.uint64
SPAN, KMER = 50, 10


def _smallest(code: np.ndarray, width: int) -> np.ndarray:
    """For each i the place of the smallest of code[i:i+width], the first one of equals.

    Spans double until one more step covers ``width``; places near the end are not meaningful.
    """
    value, place, have = code, np.arange(len(code)), 1
    while have < width:
        step = min(have, width - have)
        n = len(value) - step
        right = value[step:] < value[:n]
        value, place = np.where(right, value[step:], value[:n]), np.where(right, place[step:], place[:n])
        have += step
    return place


def paths(words, span: int, kmer: int):
    """(document, first word in it, windows, node, path) of every path of a block."""
    n = words.counts
    docs = np.flatnonzero(n >= span)
    if not len(docs):
        e = np.zeros(0, dtype=np.int64)
        return e, e, e, e.astype(np.uint64), e.astype(np.uint64)
    kmers = n[docs] - kmer + 1
    first = ragged(words.ptr[docs], kmers)                       # word at which each k-mer starts
    code = window_hash(words.code, first, kmer)
    windows = n[docs] - span + 1
    begin = ragged(np.cumsum(kmers) - kmers, windows)            # k-mer with which each window starts
    node_at = _smallest(code, span - kmer + 1)[begin]
    new = np.ones(len(begin), dtype=bool)
    new[1:] = (node_at[1:] != node_at[:-1]) | (begin[1:] != begin[:-1] + 1)
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(begin)))
    at, node = begin[head], node_at[head]
    word = first[at]
    # The place of the node is part of the path, so equal paths have equal windows in equal places.
    shape = (size * 4096 + (node - at)).astype(np.uint64)
    path = mix(range_hash(words.code, word, word + size + span - 1) ^ mix(shape))
    doc = np.repeat(docs, windows)[head]
    return doc, word - words.ptr[doc], size, code[node], path


def _paths(span: int, kmer: int):
    def run(batches):
        for part, data, offsets in blocks(batches, "text"):
            doc, start, size, node, path = paths(find_words(data, offsets), span, kmer)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id").take(pa.array(doc)),
                "start": start.astype(np.int32), "size": size.astype(np.int32),
                "node": node.view(np.int64), "path": path.view(np.int64),
            })

    return run


def _open(span: int):
    """Windows of the wanted paths of each document: (node, path, place in path, window, doc_id)."""
    def run(batches):
        for part, data, offsets in blocks(batches, "text"):
            words = find_words(data, offsets)
            wanted = part.column("wanted")
            row = np.repeat(np.arange(part.num_rows), np.diff(wanted.offsets.to_numpy()))
            w = wanted.flatten()
            size = w.field("size").to_numpy().astype(np.int64)
            start = w.field("start").to_numpy() + words.ptr[row]
            inside = start + size + span - 1 <= words.ptr[row + 1]
            row, size, start = row[inside], size[inside], start[inside]
            which = np.repeat(np.arange(len(row)), size)
            first = ragged(start, size)
            keep = pa.array(np.flatnonzero(inside)[which])
            yield pa.RecordBatch.from_pydict({
                "node": w.field("node").take(keep), "path": w.field("path").take(keep),
                "place": (first - start[which]).astype(np.int32),
                "window": window_hash(words.code, first, span).view(np.int64),
                "doc_id": part.column("doc_id").take(pa.array(row[which])),
            })

    return run


def _cut(span: int):
    def run(batches):
        for part, data, offsets in blocks(batches, "text"):
            docs = part.num_rows
            data = np.insert(data, offsets[1:], 32)              # a space ends every document
            offsets = offsets + np.arange(docs + 1)
            words = find_words(data, offsets)
            spans = part.column("spans")
            inner = spans.flatten()
            row = np.repeat(np.arange(docs), spans.value_lengths().fill_null(0).to_numpy())
            start, mask = inner.field("start").to_numpy().astype(np.int64), inner.field("mask").to_numpy()
            bits = (mask[:, None] >> np.arange(span)[None, :] & 1).astype(bool)
            which, place = np.nonzero(bits)
            low = start[which] + place + words.ptr[row[which]]
            high = np.minimum(low + span, words.ptr[row[which] + 1])
            low = np.minimum(low, high)
            depth = np.zeros(len(words.start) + 1, dtype=np.int64)
            np.add.at(depth, low, 1)
            np.add.at(depth, high, -1)
            kept = np.cumsum(depth)[:-1] == 0
            edge = np.zeros(len(data) + 1, dtype=np.int8)
            edge[words.start[kept]] += 1
            edge[words.end[kept] + 1] -= 1
            stay = np.cumsum(edge, dtype=np.int8)[:-1].astype(bool)
            out = data[stay]
            out[(out >= 9) & (out <= 13)] = 32
            size = sums(stay.astype(np.int64), offsets)
            end = np.cumsum(size)
            raw = out.tobytes()
            texts = [raw[b - n:b - 1] if n else b"" for b, n in zip(end.tolist(), size.tolist())]
            n = words.counts
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "n_words": n,
                "n_removed": n - sums(kept.astype(np.int64), words.ptr),
                "kept_sha256": [hashlib.sha256(t).hexdigest() for t in texts],
                "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
            })

    return run


def _digest(span: int):
    def run(batches):
        for batch in _cut(span)(batches):
            yield batch.drop_columns(["kept_text"])

    return run


def repeated_spans(docs: DataFrame, *, span: int = SPAN, kmer: int = KMER) -> DataFrame:
    """(doc_id, start, mask): bit i of mask says that the window at word ``start + i`` also starts in a smaller doc_id."""
    assert kmer <= span <= kmer + 61
    rows = docs.where("doc_id is not null and text is not null")
    filed = written(rows.mapInArrow(_paths(span, kmer), "doc_id long, start int, size int, node long, path long"), "paths")
    nodes = filed.groupBy("node").agg(
        F.min("doc_id").alias("source"), F.max("doc_id").alias("last"), F.min("path").alias("one"), F.max("path").alias("other")
    ).where("source < last").select("node", "source", (F.col("one") != F.col("other")).alias("branches"))
    nodes = written(nodes, "nodes")          # a join of two plain exchanges, so that a hot node's paths can be split
    shared = written(filed.join(nodes, "node"), "shared_paths")

    straight = shared.where("not branches and source < doc_id").select(
        "doc_id", "start", (F.expr("shiftleft(1L, size)") - 1).alias("mask")
    )
    branching = shared.where("branches").drop("branches", "source")
    sources = branching.groupBy("node", "path").agg(F.min(F.struct("doc_id", "start", "size")).alias("at")).select("at.*", "node", "path")
    wanted = sources.groupBy("doc_id").agg(F.collect_list(F.struct("start", "size", "node", "path")).alias("wanted"))
    opened = rows.join(wanted, "doc_id").mapInArrow(_open(span), "node long, path long, place int, window long, doc_id long")
    opened = written(opened, "windows")
    first = opened.groupBy("node", "window").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
    # A path has at most span - kmer + 1 windows, so its list is short.
    path_sources = (
        opened.select("node", "path", "place", "window").join(first, ["node", "window"])
        .groupBy("node", "path").agg(F.collect_list(F.struct("place", "source")).alias("windows"), F.min("source").alias("least"))
    )
    path_sources = written(path_sources, "path_sources")     # again plain exchanges on both sides, for a hot path
    bits = F.aggregate(
        F.filter("windows", lambda w: w["source"] < F.col("doc_id")), F.lit(0).cast("long"),
        lambda m, w: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), w["place"])),
    )
    forked = branching.join(path_sources, ["node", "path"]).where("least < doc_id").select("doc_id", "start", bits.alias("mask"))
    return straight.unionByName(forked)


def cut_repeats(docs: DataFrame, *, span: int = SPAN, kmer: int = KMER, texts: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_removed, kept_sha256 and, with ``texts``, kept_text.

    Removed is each word covered by a window of ``span`` words whose sequence also starts in a
    document with a smaller doc_id; windows are those of the input.  kept_text is the kept words
    joined by one space.  Null and empty texts have no words.  Rows with a null doc_id are no
    source and lose nothing.  Rows that repeat a doc_id should repeat its text; if they do not, the union
    of their spans is cut from each, as far as it reaches.  Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = repeated_spans(docs, span=span, kmer=kmer)
    spans = spans.groupBy("doc_id").agg(F.collect_set(F.struct("start", "mask")).alias("spans"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    joined = docs.join(spans, "doc_id", "left")
    return joined.mapInArrow(_cut(span), schema + ", kept_text string") if texts else joined.mapInArrow(_digest(span), schema)
