"""Catalog inventory, synthetic data, JSON landing."""

from pyspark.sql import functions as F

from spanmask.sources.catalog import list_tables
from spanmask.sources.synth import synth_customers


def test_list_tables(spark):
    spark.range(3).createOrReplaceTempView("inv_view_a")
    spark.sql("CREATE TABLE IF NOT EXISTS inv_tbl_b (x int) USING parquet")
    inv = list_tables(spark)
    assert inv.columns == ["table_catalog", "table_schema", "table_name", "table_type", "created", "last_altered"]
    rows = {r.table_name: r for r in inv.collect()}
    assert rows["inv_view_a"].table_type == "VIEW"
    assert rows["inv_tbl_b"].table_type == "TABLE"
    names = [(r.table_catalog, r.table_schema, r.table_name) for r in inv.collect()]
    assert names == sorted(names)
    assert spark.catalog.currentCatalog() == "spark_catalog"
    spark.sql("DROP TABLE inv_tbl_b")


def test_synth_repeatable_and_weights(spark):
    a = synth_customers(spark, 20000, freetext_cols=2, seed=7)
    assert a.columns == ["id", "firstname", "lastname", "email", "address", "operation",
                         "freetext_1", "freetext_2", "operation_date"]
    b = synth_customers(spark, 20000, freetext_cols=2, seed=7, parts=3)
    assert a.exceptAll(b).count() == 0
    share = {r.operation: r["count"] / 20000 for r in a.groupBy("operation").count().collect()}
    assert abs(share["APPEND"] - 0.5 / 0.91) < 0.02
    assert abs(share["DELETE"] - 0.1 / 0.91) < 0.02
    assert abs(share["UPDATE"] - 0.3 / 0.91) < 0.02
    assert abs(share.get(None, 0) - 0.01 / 0.91) < 0.006
    assert a.where(F.to_timestamp("operation_date", "MM-dd-yyyy HH:mm:ss").isNull()).count() == 0
    assert a.where(F.col("freetext_1") == F.col("freetext_2")).count() < 200


def test_json_roundtrip_and_inference(spark, scratch):
    from spanmask.sources.files import ingest_json, with_file_metadata, write_json
    from spanmask.operators.scan import detect_struct

    df = spark.createDataFrame([(1, "a@b.co é😀"), (2, None)], "id long, t string")
    write_json(df, f"{scratch}/j", parts=2)
    b = ingest_json(spark, f"{scratch}/j", df.schema, stream=False)
    assert sorted(b.collect()) == sorted(df.collect())
    st = with_file_metadata(ingest_json(spark, f"{scratch}/j", infer_schema=True))
    assert {"id", "t", "file_name", "processing_time"} <= set(st.columns)
    r = b.where("id = 1").select(detect_struct(["t"]).alias("s")).first().s
    assert [(x.start, x.end) for x in r.t] == [(0, 6)]


def test_empty_list_of_catalogs(spark):
    assert list_tables(spark, []).collect() == []


def test_malformed_json_keeps_its_text(spark, tmp_path):
    from spanmask.sources.files import ingest_json

    (tmp_path / "a.json").write_text('{"id": 1, "text": "ok"}\n{"id": 2, "text": broken\n')
    df = ingest_json(spark, str(tmp_path), spark.createDataFrame([], "id long, text string").schema, stream=False, corrupt_column="_corrupt_record")
    rows = {r.id: r for r in df.cache().collect()}
    assert rows[1].text == "ok" and rows[1]._corrupt_record is None
    assert rows[None]._corrupt_record == '{"id": 2, "text": broken'


def test_inventory_created_time(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS inv_tbl_c (x int) USING parquet")
    r = list_tables(spark).where("table_name = 'inv_tbl_c'").first()
    assert r.table_type == "TABLE" and r.created is not None
    spark.sql("DROP TABLE inv_tbl_c")
