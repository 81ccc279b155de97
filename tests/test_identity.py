"""Identity check on streams: every fault is found, nothing is counted twice over restarts."""

import pytest
from pyspark.sql import functions as F

from spanmask.streaming.identity import identity_counts, identity_sink, read_identity

SCHEMA = "id int, t string, n int, processing_time timestamp"
AT = "2024-01-01 00:00:00"


class Hops:
    """Two hop folders that grow file by file."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def add(self, hop, *rows):
        df = self.spark.createDataFrame([(i, t, n) for i, t, n in rows], "id int, t string, n int")
        df.withColumn("processing_time", F.lit(AT).cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{self.root}/{hop}")

    def check(self, key=("id",)):
        side = lambda hop: self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.root}/{hop}")
        identity_sink(side("landed"), side("left").withColumn("extra", F.lit(1)), list(key), f"{self.root}/out", f"{self.root}/ck")
        return sorted((r.row_key, r.n_landed, r.n_left, r.status) for r in read_identity(self.spark, f"{self.root}/out").collect())


def test_faults_and_a_hop_that_catches_up(spark, scratch):
    h = Hops(spark, scratch)
    h.add("landed", (1, "a", 1), (2, "b", 2), (3, "c", 3))
    h.add("left", (1, "a", 1))
    assert h.check() == [('["1"]', 1, 1, "ok"), ('["2"]', 1, 0, "missing"), ('["3"]', 1, 0, "missing")]
    h.add("left", (2, "b", 2), (3, "x", 3))
    h.add("left", (1, "a", 1))
    found = [('["1"]', 1, 2, "extra"), ('["2"]', 1, 1, "ok"), ('["3"]', 0, 1, "extra"), ('["3"]', 1, 0, "missing")]
    assert h.check() == found
    assert h.check() == found                              # a restart with nothing new counts nothing
    h.add("left", (3, "c", 3))
    assert h.check()[-1] == ('["3"]', 1, 1, "ok")


def test_nulls_repeats_and_swapped_cells(spark, scratch):
    h = Hops(spark, scratch)
    h.add("landed", (None, None, 1), (5, None, None), (6, "", 0), (7, "p", 1), (8, "q", 1), (9, "r", 1), (9, "r", 1))
    h.add("left", (None, None, 1), (5, None, None), (6, None, 0), (7, "q", 1), (8, "p", 1), (9, "r", 1), (9, "r", 1))
    got = h.check()
    assert (got.count(('["5"]', 1, 1, "ok")), got.count(('["9"]', 2, 2, "ok"))) == (1, 1) and ("[null]", 1, 1, "ok") in got
    assert [k for k, *_, s in got if s == "missing"] == [k for k, *_, s in got if s == "extra"] == ['["6"]', '["7"]', '["8"]']


def test_key_of_several_columns_and_missing_columns(spark, scratch):
    h = Hops(spark, scratch)
    h.add("landed", (1, "a", 1), (1, "b", 1))
    h.add("left", (1, "b", 1), (1, "a", 1))
    assert h.check(("id", "t")) == [('["1","a"]', 1, 1, "ok"), ('["1","b"]', 1, 1, "ok")]
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="lacks n"):
        identity_counts(df, df.drop("n"), ["id"])


def test_micro_batches_do_not_grow_with_the_files_of_a_hop(spark, scratch, monkeypatch):
    """Each micro-batch of a hop is written by many tasks; the next streams take what one wrote at a time, not a file."""
    from spanmask.plans import catalogue

    rows = [(i, f"row {i} mail a{i}@b.co " + "x" * 400) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{scratch}/data/documents.parquet")
    monkeypatch.setattr(catalogue, "shared_dir", lambda *_: f"{scratch}/run")
    small = {"spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "1k"}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        found = catalogue.stream_identity(spark, f"{scratch}/data").groupBy("status").count().collect()
    finally:
        for k in small:
            spark.conf.unset(k)
    times = [0 if i % 7 == 3 else 2 if i % 11 == 4 else 1 for i in range(400)]
    other = [i % 13 == 5 for i in range(400)]
    want = {"ok": sum(t == 1 and not o for t, o in zip(times, other)), "missing": sum(t == 0 or o for t, o in zip(times, other)),
            "extra": sum(t == 2 and not o or o and t > 0 for t, o in zip(times, other))}
    assert {r["status"]: r["count"] for r in found} == want
    files = lambda hop: len(spark.read.parquet(f"{scratch}/run/{hop}").inputFiles())
    assert files("raw") >= 12 and files("analysed") >= 12
    assert spark.read.parquet(f"{scratch}/run/identity").select("batch_id").distinct().count() <= 6
