"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of order 0 to ``order``, with counts from labelled
texts that are not changed afterwards.  A byte costs ``-log2`` of its probability in the longest
context that has it; from a context that lacks it the model escapes to the next shorter one,
at the price of the escape (method C: ``distinct / (total + distinct)``), at the end to
a uniform byte.  The language with the shortest code for the whole text wins.

As the counts are frozen, the cost of a byte depends on the longest known context only: a
language's costs stand in one table of its own contexts, looked up for many texts at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import blocks, sums

#: Training texts per language, about (chosen by a hash of doc_id): the bound of the model's sample.
SAMPLE_DOCS = 2000
#: Contexts of a language's table at most, its own most frequent ones: the bound of the model is this times the languages.
CONTEXTS = 20_000
ORDER = 3
#: a-z stand for both cases; other ASCII bytes are one class, as a space.
_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_LETTER = np.isin(np.arange(256), np.r_[65:91, 97:123])


def _history(classes: np.ndarray, offsets: np.ndarray, order: int) -> list[np.ndarray]:
    """The classes 1, 2, .. places before each byte; 0 (a space) before a text begins."""
    begin = offsets[:-1][np.diff(offsets) > 0]
    out, last = [], classes
    for _ in range(order):
        last = np.concatenate([last[:1], last[:-1]])
        last[begin] = 0
        out.append(last)
    return out


@dataclass
class Model:
    languages: list[str]
    classes: np.ndarray         # byte -> class
    width: int                  # number of classes
    node: list[np.ndarray]      # by language: packed context of ORDER classes -> its longest known context
    cost: list[np.ndarray]      # by language: [node * width + class] -> bits

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each text under each language."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        if len(data):
            now = self.classes[data].astype(np.int32)
            key = np.zeros(len(data), dtype=np.int32)
            for before in reversed(_history(now, offsets, ORDER)):
                key = key * np.int32(self.width) + before
            some = np.flatnonzero(np.diff(offsets) > 0)
            for i in range(len(self.languages)):
                at = self.node[i][key] * np.int32(self.width) + now
                out[some, i] = np.add.reduceat(self.cost[i][at], offsets[some], dtype=np.float64)
        return out


def build(languages: list[str], grams: np.ndarray, lang: np.ndarray, count: np.ndarray, contexts: int = CONTEXTS) -> Model:
    """Model from counted (order + 1)-byte strings, packed into integers, first byte highest."""
    used = np.unique(np.concatenate([(grams >> (8 * i)) & 0xFF for i in range(ORDER + 1)] + [np.array([32])]))
    used = np.concatenate([[32], used[used != 32]])
    width = len(used) + 1                                        # the last class: bytes never seen
    classes = np.full(256, width - 1, dtype=np.uint8)
    classes[used] = np.arange(len(used))
    classes = classes[_FOLD]
    index = np.zeros(256, dtype=np.int64)
    index[used] = np.arange(len(used))
    nodes, costs = [], []
    for i in range(len(languages)):
        mine = lang == i
        symbols = [index[(grams[mine] >> (8 * k)) & 0xFF] for k in range(ORDER, -1, -1)]      # oldest first
        node, cost = _tree(symbols, count[mine], width, contexts)
        nodes.append(node)
        costs.append(cost)
    return Model(languages, classes, width, nodes, costs)


def _tree(symbols: list[np.ndarray], count: np.ndarray, width: int, contexts: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, cost) of one language from its counted strings."""
    def pack(k: int) -> np.ndarray:
        packed = np.zeros(len(count), dtype=np.int64)
        for s in symbols[ORDER - k:ORDER]:
            packed = packed * width + s
        return packed

    # Known contexts: (order, packed); the root first, then the most frequent.
    found = []
    for k in range(1, ORDER + 1):
        keys, inverse = np.unique(pack(k), return_inverse=True)
        found.append((np.full(len(keys), k), keys, np.bincount(inverse, weights=count, minlength=len(keys))))
    order, packed, seen = (np.concatenate(x) for x in zip(*found))
    best = np.lexsort((packed, order, -seen))[:contexts - 1]
    best = best[np.argsort(order[best], kind="stable")]
    order, packed = np.append(0, order[best]), np.append(0, packed[best])
    # Costs, shorter contexts first: a context lacking a byte passes on the shorter one's cost and its escape.
    cost = np.empty((len(order), width), dtype=np.float32)
    node = np.zeros(1, dtype=np.int32)
    for k in range(ORDER + 1):
        shorter = np.tile(node, width) if k else node            # by the last k - 1 classes
        rows = np.flatnonzero(order == k)
        slot = np.full(width ** k, -1, dtype=np.int64)
        slot[packed[rows]] = np.arange(len(rows))
        at = slot[pack(k)]
        inside = at >= 0
        counts = np.bincount(at[inside] * width + symbols[ORDER][inside], weights=count[inside], minlength=len(rows) * width).reshape(len(rows), width)
        total, distinct = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
            direct = -np.log2(counts / (total + distinct))
        base = cost[shorter[packed[rows]]] if k else np.full((len(rows), width), 8.0)
        cost[rows] = np.where(counts > 0, direct, base + escape)
        known = shorter.copy()
        known[packed[rows]] = rows
        node = known
    return node.astype(np.int32), cost.reshape(-1)


def _grams(batches):
    """(lang, gram, n): strings of ORDER + 1 folded bytes, counted per batch."""
    for part, data, offsets in blocks(batches, "text"):
        folded = _FOLD[data]
        before = _history(np.where(folded == 32, 0, folded), offsets, ORDER)
        gram = folded.astype(np.int64)
        for i, b in enumerate(before):
            gram |= np.where(b == 0, 32, b).astype(np.int64) << (8 * (i + 1))
        langs = part.column("lang").dictionary_encode()
        which = np.repeat(langs.indices.to_numpy(), np.diff(offsets)).astype(np.int64)
        keys, n = np.unique(which << 40 | gram, return_counts=True)
        yield pa.RecordBatch.from_pydict({
            "lang": langs.dictionary.take(pa.array(keys >> 40)), "gram": keys & ((1 << 40) - 1), "n": n.astype(np.int64),
        })


def train(labelled: DataFrame, *, sample_docs: int = SAMPLE_DOCS, contexts: int = CONTEXTS) -> Model | None:
    """Model from (doc_id, text, lang) rows without nulls; None if there are none.

    Texts are taken whole; of a language with more than ``sample_docs`` of them, about that many.  The driver gets the distinct
    4-byte strings of those texts (24 bytes each): bounded per language.
    """
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    share = F.create_map(*(x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(int(min(1.0, sample_docs / n) * (1 << 30))))))
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) < share[F.col("lang")])
    counted = (
        chosen.select("text", "lang").mapInArrow(_grams, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    )
    if counted.empty:
        return None
    languages = sorted(counted["lang"].unique())
    lang = counted["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
    return build(languages, counted["gram"].to_numpy(), lang, counted["n"].to_numpy().astype(float), contexts)


def _letters(column, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts have a letter of any script."""
    has = sums(_LETTER[data].astype(np.int64), offsets) > 0
    wide = sums((data >= 128).astype(np.int64), offsets) > 0
    for i in np.flatnonzero(~has & wide):
        has[i] = any(map(str.isalpha, column[int(i)].as_py()))
    return has


def _predict(shared, lang_name: str, score_name: str):
    def run(batches):
        model = shared.value
        for part, data, offsets in blocks(batches, "text"):
            bits = model.bits(data, offsets)
            best = bits.argmin(axis=1)
            gap = (bits - bits.min(axis=1, keepdims=True)) * np.log(2)
            score = 1 / np.exp(-np.minimum(gap, 700)).sum(axis=1)
            ok = _letters(part.column("text"), data, offsets)
            names = np.array([*model.languages, "und"], dtype=object)
            columns = {c: part.column(c) for c in part.schema.names}
            columns[lang_name] = pa.array(names[np.where(ok, best, len(names) - 1)], pa.string())
            columns[score_name] = np.where(ok, score, 0.0)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def held_out() -> Column:
    """Documents that are never learnt from: crc32 of doc_id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, *, sample_docs: int = SAMPLE_DOCS, contexts: int = CONTEXTS, keep: tuple[str, ...] = ("doc_id",), prefix: str = "") -> DataFrame:
    """The columns ``keep`` of each row of ``docs`` (doc_id, text, lang), and held_out, lang_pred, score (with ``prefix``).

    Learnt from rows that are not held out and have a doc_id, text and lang.  score is the
    posterior of the winner under equal priors.  Texts that are null or have no letter, and all
    texts if there is nothing to learn from, get ``und`` and 0.  Equal code lengths: the first language by name.
    Rows are judged one by one, so null and repeated doc_ids pass; other columns are ignored.
    A kept column must not have the name of a new one.
    """
    out = tuple(prefix + c for c in ("held_out", "lang_pred", "score"))
    spark = docs.sparkSession
    labelled = docs.where(~held_out()).select("doc_id", "text", "lang").where("doc_id is not null and text is not null and lang is not null")
    model = train(labelled, sample_docs=sample_docs, contexts=contexts)
    names = list(dict.fromkeys((*keep, "text")))
    rows = docs.select(*names, held_out().alias(out[0]))
    if model is None:
        return rows.select(*keep, out[0], F.lit("und").alias(out[1]), F.lit(0.0).alias(out[2]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    found = rows.mapInArrow(_predict(spark.sparkContext.broadcast(model), *out[1:]), f"{schema}, `{out[1]}` string, `{out[2]}` double")
    return found.select(*keep, *out)
