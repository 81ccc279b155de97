"""Plan shape: the default scan and rewrite are narrow; parallelism shuffles before the heavy stage."""

import contextlib
import io

from spanmask import anonymize, scan


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_default_scan_and_anonymize_are_narrow(spark, scratch):
    from conftest import SF001

    path = f"{scratch}/docs"
    spark.read.parquet(f"{SF001}/documents.parquet").repartition(4).write.parquet(path)
    docs = spark.read.parquet(path)
    out = anonymize(scan(docs, exclude=["doc_id", "lang", "source", "n_chars"]))
    p = plan_text(out)
    assert "Exchange" not in p
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string,n_chars:bigint>" in p


def test_parallelism_repartitions_below_the_heavy_stage(spark):
    from conftest import SF001

    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    # scan(parallelism): the detection runs above (after) the exchange
    lines = plan_text(scan(docs, exclude=["doc_id"], parallelism=6)).splitlines()
    ex = next(i for i, l in enumerate(lines) if "Exchange RoundRobinPartitioning(6)" in l)
    det = next(i for i, l in enumerate(lines) if "regexp_extract_all" in l)
    assert det < ex
    # anonymize(parallelism): the rewrite of the spans runs above the exchange
    lines = plan_text(anonymize(scan(docs, exclude=["doc_id"]), parallelism=5)).splitlines()
    ex = next(i for i, l in enumerate(lines) if "Exchange RoundRobinPartitioning(5)" in l)
    rw = next(i for i, l in enumerate(lines) if "pii_analysis_result" in l and "analysis_results.text" in l)
    assert rw < ex


def test_masked_column_not_read(spark):
    from conftest import SF001
    from spanmask.sources.tables import customers_with_pii

    cwp = customers_with_pii(spark, SF001)
    p = plan_text(anonymize(scan(cwp, exclude=["id", "segment"], known=["fullname"])))
    assert "c_name" not in p


def test_stacked_with_mixed_types(spark):
    df = spark.createDataFrame([(1, "a@b.co", 4111111111111111, 2.5)], "id int, t string, n long, x double")
    s = scan(df, exclude=["id"], strategy="stacked").first().pii_analysis_result.analysis_results
    assert [len(s.t), len(s.n), len(s.x)] == [1, 1, 0]
