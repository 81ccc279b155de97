"""Three hops: batch == stream, restart adds nothing, two drops == one."""

import functools

import pytest
from pyspark.sql import functions as F

from spanmask import anonymize, scan
from spanmask.functions.udf import python_regex_detector
from spanmask.plans.catalogue import CWP_EXCLUDE, CWP_KNOWN, PATTERNS
from spanmask.plans.config import ScanConfig
from spanmask.sources.files import FILE_METADATA_COLS, files_per_share, ingest_json, table_bytes, with_file_metadata, write_json
from spanmask.sources.tables import customers_with_pii
from spanmask import summarize
from spanmask.streaming.hops import HopPaths, read_summary, run_hops, run_pipeline, summary_sink


def test_hops_equal_batch_and_restart(spark, scratch):
    from conftest import SF0001

    cwp = customers_with_pii(spark, SF0001)
    ids = [r.id for r in cwp.select("id").orderBy("id").collect()]
    half = ids[len(ids) // 2]
    landing = f"{scratch}/landing"
    write_json(cwp.where(F.col("id") < half), landing, parts=2)          # first drop
    conf = ScanConfig(known_pii_cols=CWP_KNOWN, cols_to_exclude=CWP_EXCLUDE)
    paths = HopPaths.under(scratch)
    run_hops(spark, landing, paths, cwp.schema, conf, recognizers=PATTERNS)
    write_json(cwp.where(F.col("id") >= half), landing, parts=2)         # second drop
    run_hops(spark, landing, paths, cwp.schema, conf, recognizers=PATTERNS)
    run_hops(spark, landing, paths, cwp.schema, conf, recognizers=PATTERNS)  # nothing new: adds nothing
    out = spark.read.parquet(paths.anonymised)
    assert out.count() == cwp.count()
    assert out.select("id").distinct().count() == cwp.count()
    batch = anonymize(scan(cwp, exclude=CWP_EXCLUDE, known=CWP_KNOWN, recognizers=PATTERNS))
    cols = ["id", "fullname", "segment", "freetext_1", "lang"]
    assert out.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(out.select(cols)).count() == 0
    raw = spark.read.parquet(paths.raw)
    assert set(FILE_METADATA_COLS) | {"processing_time"} <= set(raw.columns)
    analysed = spark.read.parquet(paths.analysed)
    assert "pii_analysis_result" in analysed.columns


def test_fused_hop_and_summary_sink(spark, scratch):
    from conftest import SF0001

    cwp = customers_with_pii(spark, SF0001)
    landing = f"{scratch}/landing"
    write_json(cwp, landing, parts=2)
    conf = ScanConfig(known_pii_cols=CWP_KNOWN, cols_to_exclude=CWP_EXCLUDE)
    paths = HopPaths.under(f"{scratch}/fused")
    run_hops(spark, landing, paths, cwp.schema, conf, recognizers=PATTERNS, keep_analysed=False)
    assert spark.read.parquet(paths.anonymised).count() == cwp.count()
    st = with_file_metadata(ingest_json(spark, landing, cwp.schema))
    scanned = scan(st, exclude=CWP_EXCLUDE + list(FILE_METADATA_COLS) + ["processing_time"], known=CWP_KNOWN)
    summary_sink(scanned, f"{scratch}/summary", f"{scratch}/_ck_summary")
    key = lambda df: sorted((r.column, r.entity_type, r.num_entities, r.sample_size, r.hit_rate) for r in df.collect())
    want = key(summarize(scan(cwp, exclude=CWP_EXCLUDE, known=CWP_KNOWN)))
    assert key(read_summary(spark, f"{scratch}/summary")) == want


def test_summary_over_several_batches(spark, scratch):
    df = spark.createDataFrame([(1, "a@b.co"), (2, "nothing"), (3, "c@d.co e@f.co"), (4, None)], "id int, t string")
    for i in range(1, 5):
        write_json(df.where(F.col("id") == i), f"{scratch}/landing", parts=1)
    st = ingest_json(spark, f"{scratch}/landing", df.schema, max_files=1)
    summary_sink(scan(st, exclude=["id"]), f"{scratch}/summary", f"{scratch}/_ck")
    assert spark.read.parquet(f"{scratch}/summary").select("batch_id").distinct().count() >= 3
    (r,) = read_summary(spark, f"{scratch}/summary").collect()
    assert (r.column, r.entity_type, r.num_entities, r.sample_size, r.hit_rate) == ("t", "EMAIL_ADDRESS", 3.0, 4, 0.5)


def test_configured_run_with_a_detector_and_a_broken_line(spark, scratch):
    df = spark.createDataFrame([(i, f"mail a{i}@b.co and {i}") for i in range(6)], "id int, t string")
    for i in range(3):
        write_json(df.where(F.col("id") % 3 == i), f"{scratch}/landing", parts=1)
    spark.createDataFrame([('{"id": 9, "t": broken z@y.org',)], "value string").write.mode("append").text(f"{scratch}/landing")
    conf = ScanConfig(ingestion_folder=f"{scratch}/landing", output_folder=f"{scratch}/out", cols_to_exclude=["id"], input_schema="id int, t string", max_files=1)
    queries = run_pipeline(spark, conf, detector=python_regex_detector(PATTERNS))
    assert all(len([p for p in q.recentProgress if p["numInputRows"]]) >= 3 for q in queries)
    rows = {r.id: r for r in spark.read.parquet(HopPaths.under(f"{scratch}/out").anonymised).collect()}
    assert len(rows) == 7 and all(rows[i].t == f"mail <EMAIL_ADDRESS> and {i}" for i in range(6))
    assert rows[None]._corrupt_record == '{"id": 9, "t": broken <EMAIL_ADDRESS>'


def test_hops_as_catalog_tables(spark, scratch):
    df = spark.createDataFrame([(i, f"mail a{i}@b.co") for i in range(6)], "id int, t string")
    conf = ScanConfig(cols_to_exclude=["id"], max_files=1)
    spark.sql(f"CREATE DATABASE hops_test LOCATION '{scratch}/base'")
    try:
        for half in (0, 1, 2):                             # the third run finds nothing new
            if half < 2:
                write_json(df.where(F.col("id") % 2 == half), f"{scratch}/landing", parts=2)
            run_hops(spark, f"{scratch}/landing", HopPaths.under(f"{scratch}/out"), df.schema, conf, database="hops_test")
            for name in ("customers_with_pii", "customers_pii_analyzed", "customers_pii_anonymized"):
                assert spark.table(f"hops_test.{name}").count() == min(half + 1, 2) * 3
        assert spark.table("hops_test.customers_pii_anonymized").where("t <> 'mail <EMAIL_ADDRESS>'").count() == 0
        with pytest.raises(ValueError, match="schema"):
            run_hops(spark, f"{scratch}/landing", HopPaths.under(f"{scratch}/out"), None, conf, database="hops_test")
    finally:
        spark.sql("DROP DATABASE hops_test CASCADE")


def test_later_hops_have_the_micro_batches_of_the_first(spark, scratch):
    """A landed file that many tasks read is many files in the next hop, but still one micro-batch."""
    df = spark.createDataFrame([(i, f"mail a{i}@b.co " + "x" * 400) for i in range(400)], "id int, t string")
    write_json(df, f"{scratch}/landing", parts=4)
    conf = ScanConfig(cols_to_exclude=["id"], max_files=1)
    small = {"spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "1k"}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        queries = run_hops(spark, f"{scratch}/landing", HopPaths.under(f"{scratch}/out"), df.schema, conf)
    finally:
        for k in small:
            spark.conf.unset(k)
    out = HopPaths.under(f"{scratch}/out")
    assert min(len(spark.read.parquet(p).inputFiles()) for p in (out.raw, out.analysed)) >= 12
    batches = [len([p for p in q.recentProgress if p["numInputRows"]]) for q in queries]
    assert batches[0] == 4 and 2 <= min(batches[1:]) and max(batches[1:]) <= 4
    rows = spark.read.parquet(out.anonymised)
    assert (rows.count(), rows.where(F.startswith("t", F.lit("mail <EMAIL_ADDRESS> x"))).count()) == (400, 400)


@pytest.mark.parametrize("query, sink", [("stream_summary", "summary"), ("stream_distinct", "distinct")])
def test_landed_files_are_bounded_and_the_micro_batches_stay(spark, scratch, monkeypatch, query, sink):
    """A large share is landed in several files, none by a task with a quarter of the table; each share is one micro-batch."""
    from spanmask.plans import catalogue

    rows = [(i, f"row {i} mail a{i % 50}@b.co " + "x" * 400) for i in range(400)] + [(400, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{scratch}/data/documents.parquet")
    monkeypatch.setattr(catalogue, "shared_dir", lambda *_: f"{scratch}/run")
    monkeypatch.setattr(catalogue, "files_per_share", functools.partial(files_per_share, landed_mb=0.01))
    (r,) = getattr(catalogue, query)(spark, f"{scratch}/data").collect()
    if sink == "summary":
        assert (r.entity_type, r.num_entities, r.sample_size) == ("EMAIL_ADDRESS", 400.0, 401)
    else:
        assert (r.entity_type, r.distinct_values, r.exact) == ("EMAIL_ADDRESS", 50, True)
    landed = spark.read.text(f"{scratch}/run/landing").select("_metadata.file_path", "_metadata.file_size").distinct().collect()
    assert max(f.file_size for f in landed) < 20_000 < sum(f.file_size for f in landed) / 4
    assert spark.read.parquet(f"{scratch}/run/{sink}").select("batch_id").distinct().count() == 4


def test_bytes_of_a_table(spark):
    df = spark.createDataFrame([(1, "ab"), (22, None), (None, "\u00e9")], "id int, `t.x` string")
    assert table_bytes(df) == 3 * (2 + 6) + 3 * (3 + 6) + (1 + 2 + 0) + (2 + 0 + 2)
    assert table_bytes(df.where("id > 99")) == 0
    assert [files_per_share(n << 20, 4, 32) for n in (0, 128, 129, 1280)] == [1, 1, 2, 10]
