"""Token output: one wavelet matrix per shard, read back from the files.

A shard holds the ids of consecutive documents, in ascending doc_id order.  Bit-plane
``l`` of its matrix has bit ``width-1-l`` of every id, in the order that sorting by the
higher bits (zeros first, stable) leaves; with counts of ones at fixed distances each plane
answers rank and select, and so the matrix answers ``token(i)``, ``count(id, i, j)``
and ``find(id, k)`` without being unpacked.

A file is Parquet written by Spark, one per shard, so it lives in any store that Spark reaches:
``shard long, n_tokens long, width int, doc_ids array<long>, lengths array<long>,
planes array<binary>`` (bits packed high bit first) ``, ones array<binary>`` (little-endian unsigned
32-bit counts of ones before every 4096th bit).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.config import shared_dir
from .text import blocks
from .tokens import encoder

#: Ids in a shard, about: a shard is closed after the document that reaches this.
SHARD_TOKENS = 1 << 21
#: Bytes of text per range partition; about a shard's worth of ids.
SHARD_BYTES = 5 << 20
#: Tasks that write shards at most; each writes as many as its part of the documents fills.
MAX_TASKS = 2048
STEP = 4096
FILE = "shard long, n_tokens long, width int, doc_ids array<long>, lengths array<long>, planes array<binary>, ones array<binary>"


class WaveletMatrix:
    def __init__(self, n: int, planes: list[bytes], ones: list[bytes]):
        self.n, self.width = n, len(planes)
        self.planes = [np.frombuffer(p, dtype=np.uint8) for p in planes]
        self.ones = [np.frombuffer(o, dtype="<u4") for o in ones]
        self.zeros = [n - self._rank(level, n) for level in range(self.width)]

    @staticmethod
    def build(ids: np.ndarray, width: int) -> tuple[list[bytes], list[bytes]]:
        planes, ones = [], []
        order = ids.astype(np.uint16 if width <= 16 else np.uint32)
        for bit in range(width - 1, -1, -1):
            set_ = (order >> order.dtype.type(bit)) & order.dtype.type(1) == 1
            packed = np.packbits(set_)
            planes.append(packed.tobytes())
            at = np.bitwise_count(np.pad(packed, (0, -len(packed) % (STEP // 8)))).reshape(-1, STEP // 8).sum(axis=1, dtype=np.int64)
            ones.append((np.cumsum(at) - at).astype("<u4").tobytes())
            if bit:
                order = np.concatenate([order[~set_], order[set_]])
        return planes, ones

    def _rank(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block, plane = i // STEP, self.planes[level]
        if block >= len(self.ones[level]):
            block = len(self.ones[level]) - 1
        if block < 0:
            return 0
        inside = plane[block * STEP // 8:(i + 7) // 8]
        count = int(self.ones[level][block]) + int(np.bitwise_count(inside).sum())
        spare = -i % 8
        return count - (int(plane[i // 8] & ((1 << spare) - 1)).bit_count() if spare else 0)

    def _select(self, level: int, one: bool, k: int) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        lo, hi = 0, self.n
        while hi - lo > 1:
            mid = (lo + hi) // 2
            before = self._rank(level, mid)
            if (before if one else mid - before) <= k:
                lo = mid
            else:
                hi = mid
        return lo

    def token(self, i: int) -> int:
        value = 0
        for level in range(self.width):
            bit = int(self.planes[level][i // 8] >> (7 - i % 8)) & 1
            before = self._rank(level, i)
            i = self.zeros[level] + before if bit else i - before
            value = value << 1 | bit
        return value

    def _bits(self, token: int) -> list[int]:
        return [token >> b & 1 for b in range(self.width - 1, -1, -1)]

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of an id in [start, end)."""
        end = self.n if end is None else end
        for level, bit in enumerate(self._bits(token)):
            a, b = self._rank(level, start), self._rank(level, end)
            start, end = (self.zeros[level] + a, self.zeros[level] + b) if bit else (start - a, end - b)
        return end - start

    def find(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of an id."""
        if not 0 <= k < self.count(token):
            raise IndexError(f"no occurrence {k} of id {token}")
        start = 0
        for level, bit in enumerate(self._bits(token)):
            a = self._rank(level, start)
            start = self.zeros[level] + a if bit else start - a
        at = start + k
        for level, bit in reversed(list(enumerate(self._bits(token)))):
            at = self._select(level, True, at - self.zeros[level]) if bit else self._select(level, False, at)
        return at

    def tokens(self) -> np.ndarray:
        """All ids in order: the planes are undone from the last to the first."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        out = np.zeros(self.n, dtype=kind)
        for level in range(self.width - 1, -1, -1):
            set_ = np.unpackbits(self.planes[level], count=self.n).view(bool)
            if level < self.width - 1:
                up = np.empty_like(out)
                up[~set_] = out[:self.zeros[level]]
                up[set_] = out[self.zeros[level]:]
                out = up
            out |= set_.astype(kind) << kind(self.width - 1 - level)
        return out


def _shards(path: str, end: int):
    def run(batches):
        enc = encoder(path)
        number, ids, docs, lengths, held = TaskContext.get().partitionId() << 24, [], [], [], 0

        def shard():
            planes, ones = WaveletMatrix.build(np.concatenate(ids), enc.width)
            one = lambda x, kind: pa.array([x], type=kind)
            return pa.RecordBatch.from_arrays(
                [one(number, pa.int64()), one(held, pa.int64()), one(enc.width, pa.int32()), one(docs, pa.list_(pa.int64())),
                 one(lengths, pa.list_(pa.int64())), one(planes, pa.list_(pa.binary())), one(ones, pa.list_(pa.binary()))],
                ["shard", "n_tokens", "width", "doc_ids", "lengths", "planes", "ones"],
            )

        for part, data, offsets in blocks(batches, "text"):
            got, counts = enc.encode(data, offsets, end)
            ids.append(got)
            docs += part.column("doc_id").to_pylist()
            lengths += counts.tolist()
            held += len(got)
            if held >= SHARD_TOKENS:
                yield shard()
                number, ids, docs, lengths, held = number + 1, [], [], [], 0
        if docs:
            yield shard()

    return run


def write_shards(docs: DataFrame, path: str, tokenizer: str, *, end: int = 1, shard_bytes: int = SHARD_BYTES, max_tasks: int = MAX_TASKS) -> None:
    """Write (doc_id, text) as shard files to ``path``, in ascending doc_id order (null first, repeated
    ids by text); null texts are empty; every document is followed by the end id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    (
        docs.repartitionByRange(min(max_tasks, max(1, -(-size // shard_bytes))), "doc_id").sortWithinPartitions("doc_id", "text")
        .mapInArrow(_shards(tokenizer, end), FILE).write.mode("overwrite").parquet(path)
    )


def read_shards(spark, path: str) -> DataFrame:
    """The shard files of a folder; ``WaveletMatrix(n_tokens, planes, ones)`` opens one."""
    return spark.read.schema(FILE).parquet(path)


def _documents(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda name: batch.column(name)[row].as_py()  # noqa: E731,B023
            ids = WaveletMatrix(get("n_tokens"), get("planes"), get("ones")).tokens().astype("<u4")
            lengths = np.array(get("lengths"), dtype=np.int64)
            start = np.cumsum(lengths) - lengths
            crc = [zlib.crc32(ids[a:a + n]) for a, n in zip(start.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([get("shard")] * len(crc), pa.int64()), pa.array(get("doc_ids"), pa.int64()), pa.array(start), pa.array(lengths), pa.array(crc, pa.int64())],
                ["shard", "doc_id", "start", "n_tokens", "ids_crc32"],
            )


def document_digests(spark, path: str) -> DataFrame:
    """Per document of the shard files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    files = read_shards(spark, path)
    # Running totals in two levels: over the tasks that wrote (a bounded number), and over the shards of each.
    # The files are read where they are; only a few numbers per document meet the totals.
    sizes = files.select("shard", F.shiftright("shard", 24).alias("task"), "n_tokens")
    tasks = sizes.groupBy("task").agg(F.sum("n_tokens").alias("n"))
    tasks = tasks.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("earlier"))
    inside = F.sum("n_tokens").over(Window.partitionBy("task").orderBy("shard")) - F.col("n_tokens")
    before = sizes.withColumn("inside", inside).join(F.broadcast(tasks), "task").select("shard", (F.col("earlier") + F.col("inside")).alias("before"))
    found = files.drop("width").mapInArrow(_documents, "shard long, doc_id long, start long, n_tokens long, ids_crc32 long")
    return found.join(before, "shard").select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer: str, *, end: int = 1, path: str | None = None) -> DataFrame:
    """Write the shards (to ``path`` or the shared folder) and return what the files hold per document.

    An empty table writes an empty folder and returns no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    path = path or shared_dir(spark, "shards")
    write_shards(docs, path, tokenizer, end=end)
    return document_digests(spark, path)
