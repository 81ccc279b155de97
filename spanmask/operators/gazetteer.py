"""Dictionary (gazetteer) recogniser: names and places by lookup.

A candidate is some consecutive words (runs of letters) of a text, as written between the first and
the last of them; it matches a term if the two are equal in lower case with white space
runs as one space, so ``new york`` and ``o'brien`` are found.  A term with several
labels gives one span for each; overlap resolution chooses among them.

The terms make a trie of words: a node for every beginning of a term that ends with a word, kept as a sorted
array of hashes.  All words of a block of texts walk it together, a word further in each step, and only the words that
still stand on a node with more below take another step, so a long term costs no more than the texts that begin like it.

The lookup has two forms with equal results.  A trie whose size, as built, is
within the broadcast limit goes to the tasks and texts are probed in one Arrow pass, all columns of a row at once.
For a larger dictionary the tasks get a bit filter of bounded size, built by Spark from the nodes;
candidates that pass it are joined with the dictionary on the term.  Words outside the
dictionary are gone by then, and hot terms are split by adaptive skew join.

:func:`fuzzy_spans` finds terms with at most one typing error, by the deletion neighbourhoods of terms and words.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator, Optional, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.spans import SPANS_TYPE, concat_spans
from ..functions.words import WordTexts, mix, text_blocks
from .columns import RESULT_COL, pack_result, q, result_columns, spans_col

# --- fixed values --------------------------------------------------------
# Small built-in dictionary (lower case): common given names and European
# cities, entity PERSON / LOCATION, score 0.5.
PERSON_NAMES = (
    "alice", "anna", "bob", "carlos", "hans", "jean", "john", "lucia", "maria", "marie", "peter",
)
PLACE_NAMES = ("berlin", "lyon", "london", "madrid", "munich", "paris", "rome", "sevilla", "vienna")
GAZETTEER_SCORE = 0.5
# -------------------------------------------------------------------------

#: Bytes of a built trie up to which it is broadcast; a Python worker maps the same bytes again.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
#: Bits of the filter for larger dictionaries (2**26: 8 MB).
FILTER_BITS = 26
#: Characters that a term has at least to be found with a typing error.
FUZZY_LENGTH = 5
#: Score of a hit with a typing error, as a part of the term's.
FUZZY_SCORE = 0.8

WORDS = r"\p{L}+"
_WORD = regex.compile(WORDS)
_CANDIDATES = T.ArrayType(T.StructType([
    T.StructField("term", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
]))


def builtin_dictionary(spark: SparkSession) -> DataFrame:
    rows = [(n, "PERSON") for n in PERSON_NAMES] + [(n, "LOCATION") for n in PLACE_NAMES]
    terms = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(e).alias("entity_type"), F.lit(GAZETTEER_SCORE).alias("score")) for t, e in rows])
    return spark.range(1).select(F.inline(terms))


def _normalised(text: Column) -> Column:
    """Lower case, runs of (Unicode) white space as one space, none at the ends: what ``_normal`` does in Python."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)[\s\x1c-\x1f]+", " "))


def normalise_dictionary(dictionary: DataFrame, default_entity: str = "PERSON",
                         default_score: float = GAZETTEER_SCORE) -> DataFrame:
    """``term, entity_type, score``: terms in lower case, white space runs as one space; the best score per label."""
    cols = dictionary.columns
    d = dictionary.select(
        _normalised(F.col("term")).alias("term"),
        (F.col("entity_type") if "entity_type" in cols else F.lit(default_entity)).alias("entity_type"),
        (F.col("score").cast("double") if "score" in cols else F.lit(float(default_score))).alias("score"),
    ).where(F.coalesce(F.length("term"), F.lit(0)) > 0)
    return d.groupBy("term", "entity_type").agg(F.max("score").alias("score"))


#: Bytes of a node (hash, term, flag) and of a label (type, score).
_NODE, _LABEL = 8 + 4 + 1, 4 + 8


def measure_dictionary(terms: DataFrame) -> tuple[int, int]:
    """(bytes of the built trie at most, words in the longest term) of a normalised dictionary -- one small aggregate job.

    A term that does not begin and end with a letter could never match, and is an error.
    """
    edges = F.col("term").rlike(r"^\p{L}") & F.col("term").rlike(r"\p{L}$")
    words = F.regexp_count("term", F.lit(WORDS))
    r = terms.agg(
        F.coalesce(F.sum(F.octet_length("term") + 16 + words * _NODE + _LABEL), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(words), F.lit(0)).alias("words"),
        F.min(F.when(~edges, F.col("term"))).alias("odd"),
    ).first()
    if r["odd"] is not None:
        raise ValueError(f"dictionary terms must begin and end with a letter: {r['odd']!r}")
    return int(r["bytes"]), int(r["words"])


def candidates(text: str, n: int) -> Iterator[tuple[str, int, int]]:
    """(normalised words, start, end) of one to n consecutive words."""
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    for i, (start, _) in enumerate(words):
        for _, end in words[i:i + n]:
            yield _normal(text[start:end]), start, end


def _normal(text: str) -> str:
    return " ".join(text.lower().split())


#: Letters whose lower case is no single character of its own (capital I with a dot) or depends on the
#: place in a word (capital sigma): texts with them are looked up candidate by candidate.
_WIDE = regex.compile("[\u0130\u03a3]")


def term_nodes(terms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, hash, is the whole term) of each beginning of each term that ends with a word."""
    words = WordTexts(terms)
    first = np.cumsum(words.words) - words.words
    at = np.arange(len(words.start))
    return words.doc, words.hash(first[words.doc], at), words.left == 1


@dataclass
class Trie:
    """A dictionary in flat arrays."""

    keys: np.ndarray        # sorted hashes of the nodes
    term: np.ndarray        # number of the term that ends at a node, or -1
    more: np.ndarray        # a longer term goes on from it
    text: bytes             # all terms, one after the other
    offsets: np.ndarray
    label_at: np.ndarray    # labels of term i are label_at[i]:label_at[i + 1]
    entity: np.ndarray      # number of each label's entity type
    score: np.ndarray
    entities: list[str]
    words: int              # words of the longest term

    @classmethod
    def build(cls, rows: Sequence[tuple[str, str, float]]) -> "Trie":
        """From (normalised term, entity type, score)."""
        rows = sorted(rows)
        terms = sorted({r[0] for r in rows})
        entities = sorted({r[1] for r in rows})
        number, kind = {t: i for i, t in enumerate(terms)}, {e: i for i, e in enumerate(entities)}
        doc, key, whole = term_nodes(terms)
        order = np.lexsort((~whole, key))
        doc, key, whole = doc[order], key[order], whole[order]
        first = np.ones(len(key), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        keys = key[first]
        more = np.zeros(len(keys), dtype=bool)
        more[np.searchsorted(keys, key[~whole])] = True
        encoded = [t.encode() for t in terms]
        sizes = np.array([len(t) for t in encoded], dtype=np.int64)
        labels = np.bincount([number[t] for t, _, _ in rows], minlength=len(terms)) if rows else np.zeros(0, dtype=np.int64)
        return cls(
            keys, np.where(whole[first], doc[first], -1).astype(np.int32), more, b"".join(encoded), np.concatenate([[0], np.cumsum(sizes)]),
            np.concatenate([[0], np.cumsum(labels)]).astype(np.int64), np.array([kind[e] for _, e, _ in rows], dtype=np.int32),
            np.array([s for _, _, s in rows], dtype=np.float64), entities, int(np.bincount(doc).max()) if len(doc) else 0)

    @property
    def nbytes(self) -> int:
        return len(self.text) + sum(x.nbytes for x in (self.keys, self.term, self.more, self.offsets, self.label_at, self.entity, self.score))

    def spelled(self, i: int) -> str:
        return self.text[self.offsets[i]:self.offsets[i + 1]].decode()

    def find(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """(text, start, end, term) of every hit in a block of texts."""
        words = WordTexts(texts)
        live, step, hits = np.arange(len(words.start)), 0, []
        while len(live) and len(self.keys):
            to = live + step
            key = words.hash(live, to)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            ends = found & (self.term[at] >= 0)
            hits.append((live[ends], to[ends], self.term[at[ends]]))
            step += 1
            live = live[found & self.more[at] & (words.left[live] > step)]
        if not hits:
            return (np.zeros(0, dtype=np.int64),) * 4
        word, to, term = (np.concatenate(x) for x in zip(*hits))
        out = words.doc[word], words.start[word], words.end[to], term
        # Equal hashes are checked on the characters; texts with wide letters are looked up by themselves.
        right = np.fromiter((_normal(texts[d][a:b]) == self.spelled(t) for d, a, b, t in zip(*(x.tolist() for x in out))), dtype=bool, count=len(word))
        wide = [i for i, t in enumerate(texts) if _WIDE.search(t)]
        if wide:
            known = {self.spelled(i): i for i in range(len(self.offsets) - 1)}
            extra = [(i, a, b, known[t]) for i in wide for t, a, b in candidates(texts[i], self.words) if t in known]
            right &= ~np.isin(out[0], wide)
            out = tuple(np.concatenate([x[right], np.array(y, dtype=np.int64)]) for x, y in zip(out, zip(*extra) if extra else ((),) * 4))
            return out
        return tuple(x[right] for x in out)

    def spans(self, texts: list) -> pa.Array:
        """The span arrays of texts, sorted by (start, end desc, entity type); nulls have none."""
        docs, starts, ends, terms = [], [], [], []
        for first, block in text_blocks(texts):
            d, a, b, t = self.find(block)
            docs.append(d + first), starts.append(a), ends.append(b), terms.append(t)
        none = np.zeros(0, dtype=np.int64)
        doc, start, end, term = (np.concatenate(x) if x else none for x in (docs, starts, ends, terms))
        n = self.label_at[term + 1] - self.label_at[term]
        row = np.repeat(np.arange(len(term)), n)
        label = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.label_at[term], n)
        doc, start, end, kind, score = doc[row], start[row], end[row], self.entity[label], self.score[label]
        order = np.lexsort((kind, -end, start, doc))
        doc, start, end, kind, score = (x[order] for x in (doc, start, end, kind, score))
        names = pa.array(self.entities, pa.string()).take(pa.array(kind)) if len(kind) else pa.array([], pa.string())
        span = pa.StructArray.from_arrays(
            [names, pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(score)], names=["entity_type", "start", "end", "score"])
        where = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(where), span)


def _shared_trie(terms: DataFrame, max_bytes: int):
    size, _ = measure_dictionary(terms)
    if size > max_bytes:
        raise ValueError(f"a dictionary of {size} bytes is not broadcast; use gazetteer_spans or add_gazetteer")
    trie = Trie.build([tuple(r) for r in terms.select("term", "entity_type", "score").collect()])
    assert trie.nbytes <= size + 64, "a built trie is never larger than measured"
    return terms.sparkSession.sparkContext.broadcast(trie)


def gazetteer_detector(dictionary: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES):
    """Span detector of a dictionary whose trie is within ``max_bytes``; for ``scan(detector=...)``.

    A larger dictionary is an error here; :func:`gazetteer_spans` and :func:`add_gazetteer` take any size.
    """
    shared = _shared_trie(normalise_dictionary(dictionary), max_bytes)

    @F.arrow_udf(SPANS_TYPE)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield shared.value.spans(texts.to_pylist())

    return lambda c: found(c.cast("string"))


def _row_lookup(terms: DataFrame, max_bytes: int):
    """Function from columns to an array of their span arrays: all cells of a row cross to Python together."""
    shared = _shared_trie(terms, max_bytes)

    @F.arrow_udf(T.ArrayType(SPANS_TYPE))
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            spans = shared.value.spans(rows.flatten().to_pylist())
            sizes = np.concatenate([[0], np.cumsum(rows.value_lengths().to_numpy(zero_copy_only=False))])
            yield pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), spans)

    return lambda columns: found(F.array(*[c.cast("string") for c in columns]))


def _bits(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit filter of the column ``hash``; its cells are put together by Spark."""
    place = F.col("hash").bitwiseAND((1 << bits) - 1)
    cells = (
        keys.select(place.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")).toPandas()
    )
    table = np.zeros(1 << (bits - 6), dtype=np.uint64)
    table[cells["cell"].to_numpy()] = cells["bits"].to_numpy().view(np.uint64)
    return table


def _set(table: np.ndarray, bits: int, key: np.ndarray) -> np.ndarray:
    at = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
    return (table[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def _ending(key: np.ndarray) -> np.ndarray:
    """Another hash of a node, for the end of a term."""
    return mix(key + np.uint64(1))


def _node_hashes(batches):
    for batch in batches:
        _, key, whole = term_nodes(batch.column("term").to_pylist())
        yield pa.RecordBatch.from_pydict({"hash": np.concatenate([key, _ending(key[whole])]).view(np.int64)})


def _passing(terms: DataFrame, n: int, bits: int):
    """Column function: the candidates of a text that pass the bit filter of the nodes and of the ends of terms."""
    shared = terms.sparkSession.sparkContext.broadcast(_bits(terms.select("term").mapInArrow(_node_hashes, "hash long"), bits))

    def walk(texts: list[str]) -> list[list[dict]]:
        words, out = WordTexts(texts), [[] for _ in texts]
        live = np.arange(len(words.start))
        for step in range(n):
            if not len(live):
                break
            key = words.hash(live, live + step)
            ends = _set(shared.value, bits, _ending(key))
            for w in live[ends].tolist():
                d, a, b = int(words.doc[w]), int(words.start[w]), int(words.end[w + step])
                out[d].append({"term": _normal(texts[d][a:b]), "start": a, "end": b})
            live = live[_set(shared.value, bits, key) & (words.left[live] > step + 1)]
        for i, t in enumerate(texts):
            if _WIDE.search(t):
                out[i] = [{"term": term, "start": a, "end": b} for term, a, b in candidates(t, n)]
        return out

    @F.arrow_udf(_CANDIDATES)
    def passing(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for texts in batches:
            yield pa.array([x for _, block in text_blocks(texts.to_pylist()) for x in walk(block)], kind)

    return passing


def gazetteer_spans(
    df: DataFrame,
    key: str,
    text_col: str,
    dictionary: Optional[DataFrame] = None,
    broadcast: Optional[bool] = None,
    max_bytes: int = MAX_BROADCAST_BYTES,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Rows ``key, term, entity_type, start, end, score`` for dictionary hits.

    ``broadcast=None`` measures the dictionary and probes a broadcast set when it is
    within ``max_bytes``, else joins.  ``True`` insists on the set, and is an error beyond
    ``max_bytes``; ``False`` joins.
    """
    terms = normalise_dictionary(dictionary if dictionary is not None else builtin_dictionary(df.sparkSession))
    size, n = measure_dictionary(terms)
    if broadcast is None:
        broadcast = size <= max_bytes
    text = q(text_col).cast("string")
    if broadcast:
        found = gazetteer_detector(terms, max_bytes)(text)
        rows = df.select(q(key).alias(key), text.alias("_text"), F.inline(found))
        term = _normalised(F.col("_text").substr(F.col("start") + 1, F.col("end") - F.col("start")))
        return rows.select(key, term.alias("term"), "entity_type", "start", "end", "score")
    words = df.select(q(key).alias(key), F.inline(_passing(terms, n, filter_bits)(text)))
    return words.join(terms, "term").select(key, "term", "entity_type", "start", "end", "score")


def add_gazetteer(scanned: DataFrame, key: str, dictionary: Optional[DataFrame] = None, result_col: str = RESULT_COL,
                  broadcast: Optional[bool] = None, max_bytes: int = MAX_BROADCAST_BYTES, filter_bits: int = FILTER_BITS) -> DataFrame:
    """A scanned table with the dictionary hits of its analysed columns merged into the result column.

    For a dictionary of any size, measured once, and in one pass over the table.  Within ``max_bytes`` the hits are found row by
    row, without a shuffle.  Beyond it (or with ``broadcast=False``) ``key`` must tell rows apart: only
    keys and spans are shuffled for the lookup and joined back.
    """
    analysed, known = result_columns(scanned, result_col)
    if not analysed:
        return scanned
    nested = "nested" if "analysis_results" in scanned.schema[result_col].dataType.fieldNames() else "flat"
    terms = normalise_dictionary(dictionary if dictionary is not None else builtin_dictionary(scanned.sparkSession))
    size, n = measure_dictionary(terms)
    if broadcast or broadcast is None and size <= max_bytes:
        hits = "_" * (1 + max(map(len, scanned.columns)))            # no column has such a name
        rows = scanned.withColumn(hits, _row_lookup(terms, max_bytes)([q(c) for c in analysed]))
        merged = {c: concat_spans(spans_col(scanned, c, result_col), F.col(hits)[i]) for i, c in enumerate(analysed)}
        result = pack_result(merged, known, nested)
        return rows.select(*[result.alias(c) if c == result_col else q(c) for c in scanned.columns])
    cells = scanned.select(q(key).alias("_key"), F.posexplode(F.array(*[q(c).cast("string") for c in analysed])).alias("_at", "_cell"))
    found = cells.select("_key", "_at", F.inline(_passing(terms, n, filter_bits)(F.col("_cell")))).join(terms, "term")
    found = found.select("_key", "_at", F.struct("entity_type", "start", "end", "score").alias("_span"))
    # The spans of one row: no more than the row's own text holds.
    each = found.groupBy("_key").agg(*[
        F.collect_list(F.when(F.col("_at") == i, F.col("_span"))).alias(f"_g{i}") for i in range(len(analysed))
    ])
    merged = {c: concat_spans(spans_col(scanned, c, result_col), F.col(f"_g{i}")) for i, c in enumerate(analysed)}
    joined = scanned.join(each, q(key) == F.col("_key"), "left")
    result = pack_result(merged, known, nested)
    return joined.select(*[result.alias(c) if c == result_col else q(c) for c in scanned.columns])


# --- with a typing error ------------------------------------------------------

_NEAR = "array<struct<word: string, `start`: int, `end`: int, hashes: array<bigint>>>"


def _neighbours(batches):
    """(term, hash) of each term and of each term with one character left out."""
    for batch in batches:
        terms = batch.column("term").to_pylist()
        words = WordTexts(terms)
        first = np.cumsum(words.words) - words.words
        last = first + words.words - 1
        row, key = words.deletions(first, last)
        term = np.concatenate([np.arange(len(terms)), row])
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()).take(pa.array(term)), pa.array(np.concatenate([words.hash(first, last), key]).view(np.int64))], names=["near", "hash"])


def _near_words(table, bits: int, n: int, shortest: int):
    """Column function: candidates of a text with the hashes of their neighbourhood that pass the filter."""

    def walk(texts: list[str]) -> list[list[dict]]:
        words, out = WordTexts(texts), [[] for _ in texts]
        for step in range(n):
            word = np.flatnonzero(words.left > step)
            word = word[words.high[word + step] - words.low[word] >= shortest - 1]
            if not len(word):
                continue
            row, key = words.deletions(word, word + step)
            row, key = np.concatenate([np.arange(len(word)), row]), np.concatenate([words.hash(word, word + step), key])
            passed = _set(table.value, bits, key)
            row, key = row[passed], key[passed]
            order = np.argsort(row, kind="stable")
            row, key = row[order], key[order].view(np.int64)
            cuts = np.flatnonzero(np.diff(row, prepend=-1))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(row)]):
                w = word[row[a]]
                d, i, j = int(words.doc[w]), int(words.start[w]), int(words.end[w + step])
                out[d].append({"word": _normal(texts[d][i:j]), "start": i, "end": j, "hashes": sorted(set(key[a:b].tolist()))})
        return out

    @F.arrow_udf(_NEAR)
    def near(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("word", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("hashes", pa.list_(pa.int64()))]))
        for texts in batches:
            yield pa.array([x for _, block in text_blocks(texts.to_pylist()) for x in walk(block)], kind)

    return near


def fuzzy_spans(
    df: DataFrame, key: str, text_col: str, dictionary: Optional[DataFrame] = None, shortest: int = FUZZY_LENGTH, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Rows ``key, word, term, distance, entity_type, start, end, score``: dictionary terms with at most one typing error.

    A typing error is one character left out, put in or replaced (edit distance 1) in the words as the dictionary compares them.  Terms
    under ``shortest`` characters are left to the exact lookup.  Candidates have up to as many words as the longest term, so a space may be missing but
    none may be put in.  Scores of hits with an error are 0.8 of the term's.  Null and empty texts have no hit.

    Two strings within distance 1 share a member of their deletion neighbourhoods (the string itself and the string without one of its
    characters).  Tasks hash the neighbourhood of each candidate and drop what a bit filter of the terms' neighbourhoods does not know.
    What is left is made distinct and spread by (hash, word), joined, and verified by edit distance, so a common
    word is compared once, however often it stands in the texts; its occurrences are joined with its few terms afterwards.
    """
    terms = normalise_dictionary(dictionary if dictionary is not None else builtin_dictionary(df.sparkSession)).where(F.length("term") >= shortest)
    _, n = measure_dictionary(terms)
    index = terms.select("term").distinct().mapInArrow(_neighbours, "near string, hash long").distinct()
    table = df.sparkSession.sparkContext.broadcast(_bits(index, filter_bits))
    text = q(text_col).cast("string")
    hits = df.select(q(key).alias(key), F.inline(_near_words(table, filter_bits, n, shortest)(text)))
    words = hits.select("word", F.explode("hashes").alias("hash")).distinct()
    distance = F.levenshtein("word", "near")
    pairs = words.join(index, "hash").where(distance <= 1).select("word", F.col("near").alias("term"), distance.alias("distance")).distinct()
    found = hits.drop("hashes").join(pairs, "word").join(terms, "term")
    score = F.when(F.col("distance") == 0, F.col("score")).otherwise(F.col("score") * FUZZY_SCORE)
    return found.select(key, "word", "term", "distance", "entity_type", "start", "end", score.alias("score"))
