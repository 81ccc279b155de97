"""Table scan and anonymise: column plan, layouts, strategies, invariants."""

import warnings

import pytest
from pyspark.sql import functions as F

from spanmask import anonymize, full_mask, plan_columns, result_columns, scan, summarize
from spanmask.functions.recognizers import BUILTIN
from spanmask.functions.udf import python_regex_detector
from spanmask.plans.config import ScanConfig, parse_list

ROWS = [
    (1, "Ann Lee", "mail a@b.co now", "+1 (555) 123-4567", 7),
    (2, "Bo Kim", None, "nothing", 8),
    (2, "Cy Dee", "x@y.org and 10.0.0.1", "", 9),   # duplicate id
]
SCHEMA = "id long, name string, note string, `ph.one` string, n int"


@pytest.fixture()
def people(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_plan_columns(people):
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        p = plan_columns(people, exclude=["id", "nope"], known=["name", "missing"])
    assert p.scanned == ["note", "ph.one", "n"]
    assert p.known == ["name"]
    assert any("missing" in str(x.message) for x in w)
    assert parse_list("") == [] and parse_list(" a, ,b ") == ["a", "b"]


def test_nested_layout_and_roundtrip(people):
    s = scan(people, exclude=["id", "n"], known=["name"])
    assert result_columns(s) == (["note", "ph.one"], ["name"])
    r = s.orderBy("note").select("pii_analysis_result").collect()
    assert {x.pii_analysis_result.known_pii_columns.name for x in r} == {"Full mask"}
    a = anonymize(s).orderBy("n").collect()
    assert [x.name for x in a] == ["<PII_MASKED>"] * 3
    assert a[0].note == "mail <EMAIL_ADDRESS> now" and a[0]["ph.one"] == "<PHONE_NUMBER>"
    assert a[1].note is None                               # null stays null
    assert a[2].note == "<EMAIL_ADDRESS> and <IP_ADDRESS>"
    assert [x.id for x in a] == [1, 2, 2]                  # duplicate ids keep their own rows
    assert anonymize(s).columns == people.columns          # order kept, result dropped


def test_no_known_columns_omits_member(people):
    s = scan(people, exclude=["id", "n", "name"])
    assert s.schema["pii_analysis_result"].dataType.fieldNames() == ["analysis_results"]
    assert anonymize(s).count() == 3


def test_flat_layout_anonymizes(people):
    s = scan(people, exclude=["id", "name", "n"], layout="flat")
    assert s.schema["pii_analysis_result"].dataType.fieldNames() == ["note", "ph.one"]
    assert anonymize(s).where(F.col("note").contains("@")).count() == 0


def _counts(df):
    return sorted((r.id, r.name, r.note, r.c) for r in df.select(
        "id", "name", "note", F.size("pii_analysis_result.analysis_results.note").alias("c")).collect())


def test_strategies_agree(people):
    base = scan(people, exclude=["id", "n"], known=["name"])
    assert _counts(scan(people, exclude=["id", "n"], known=["name"], strategy="stacked")) == _counts(base)
    assert _counts(scan(people, exclude=["id", "n"], known=["name"], parallelism=4)) == _counts(base)
    assert _counts(scan(people, exclude=["id", "n"], known=["name"], id_check=True)) == _counts(base)
    dbg = scan(people, exclude=["id", "n"], known=["name"], id_debug=True)
    assert "monotonic_id" in dbg.columns
    assert dbg.schema["monotonic_id"].dataType.simpleString() == "bigint"


def test_udf_detector_matches_native(people):
    recs = [BUILTIN["EMAIL_ADDRESS"], BUILTIN["PHONE_NUMBER"]]
    a = scan(people, exclude=["id", "n", "name"], recognizers=recs)
    b = scan(people, exclude=["id", "n", "name"], detector=python_regex_detector(recs))
    key = lambda df: sorted((r.name, str(r.pii_analysis_result)) for r in df.collect())
    assert key(a) == key(b)


def test_stream_guards(spark, scratch):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{scratch}/in")
    st = spark.readStream.schema(spark.read.parquet(f"{scratch}/in").schema).parquet(f"{scratch}/in")
    for kw in ({"strategy": "stacked"}, {"id_check": True}, {"id_debug": True}):
        with pytest.raises(ValueError):
            scan(st, exclude=["id"], **kw)


def test_full_mask(people):
    m = full_mask(people, ["name", "note"], mask_nulls=False).orderBy("n").collect()
    assert [x.note for x in m] == ["<PII_MASKED>", None, "<PII_MASKED>"]
    assert full_mask(people, ["note"]).orderBy("n").collect()[1].note == "<PII_MASKED>"


def test_summary_brute_force(people):
    s = scan(people, exclude=["id", "n"], known=["name"])
    got = {(r.column, r.entity_type): r for r in summarize(s).collect()}
    assert set(got) == {("note", "EMAIL_ADDRESS"), ("note", "IP_ADDRESS"), ("ph.one", "PHONE_NUMBER")}
    e = got[("note", "EMAIL_ADDRESS")]
    assert (e.num_entities, e.avg_score, e.sample_size, e.hit_rate) == (2.0, 1.0, 3, 2 / 3)
    assert got[("ph.one", "PHONE_NUMBER")].hit_rate == 1 / 3


def test_invariants_on_documents(spark):
    """Rows kept, text outside spans kept, idempotent, nothing detected survives."""
    from conftest import SF001

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    s = scan(docs, exclude=["doc_id", "lang", "source", "n_chars"])
    a = anonymize(s)
    assert a.count() == docs.count() and a.columns == docs.columns
    again = anonymize(scan(a, exclude=["doc_id", "lang", "source", "n_chars"]))
    diff = a.alias("x").join(again.alias("y"), "doc_id").where(F.col("x.text") != F.col("y.text")).count()
    assert diff == 0
    left = scan(a, exclude=["doc_id", "lang", "source", "n_chars"])
    assert left.where(F.size("pii_analysis_result.analysis_results.text") > 0).count() == 0
    # removing the replacement tokens from both sides leaves identical text
    gaps = s.select("doc_id", F.col("pii_analysis_result.analysis_results.text").alias("sp"), "text")
    rows = gaps.collect()
    out = {r.doc_id: r.text for r in a.select("doc_id", "text").collect()}
    for r in rows:
        kept, pos = [], 0
        for x in r.sp:
            kept.append(r.text[pos:x.start])
            pos = max(pos, x.end)
        kept.append(r.text[pos:])
        import re
        assert re.sub("<[A-Z_]+>", "", out[r.doc_id]) == "".join(kept)


def test_scan_config_from_spark(spark):
    spark.conf.set("known_pii_cols", "firstname,lastname")
    spark.conf.set("cols_to_exclude", "id, operation,")
    c = ScanConfig.from_spark(spark)
    assert c.known_pii_cols == ["firstname", "lastname"] and c.cols_to_exclude == ["id", "operation"]


def test_types_survive(spark):
    df = spark.createDataFrame([(1, 2.5, ["a@b.co"], 4111111111111111, "a@b.co"), (2, 1.0, ["x"], 7, "y")], "id int, x double, a array<string>, n long, t string")
    out = anonymize(scan(df))
    assert out.schema.simpleString() == df.schema.simpleString()
    rows = {r.id: r for r in out.collect()}
    assert rows[1].x == 2.5 and rows[1].a is None and rows[1].n is None and rows[1].t == "<EMAIL_ADDRESS>"
    assert tuple(rows[2]) == (2, 1.0, ["x"], 7, "y")
    assert plan_columns(df, strings_only=True).scanned == ["t"]
    assert list(scan(df, strings_only=True).schema["pii_analysis_result"].dataType["analysis_results"].dataType.fieldNames()) == ["t"]


def test_id_check_fails_on_a_key_that_is_not_unique(people):
    with pytest.raises(Exception, match="wrong row"):
        scan(people, exclude=["id"], id_check=True, key="id").select("id").collect()
    assert scan(people, exclude=["n"], id_check=True, key="n").count() == 3


def test_keyed_strategies_need_no_checkpoint(people):
    base = scan(people, exclude=["id", "n"], known=["name"])
    assert _counts(scan(people, exclude=["id", "n"], known=["name"], strategy="stacked", key="n")) == _counts(base)
    assert _counts(scan(people, exclude=["id", "n"], known=["name"], id_check=True, key="n")) == _counts(base)
    plan = scan(people, exclude=["id", "n"], strategy="stacked", key="n")._jdf.queryExecution().optimizedPlan().toString()
    assert "Scan ExistingRDD" not in plan or "checkpoint" not in plan.lower()


def test_batch_and_row_detectors(spark, people):
    from spanmask.functions.udf import python_regex_factory, register_batch_detector, register_row_detector
    from spanmask.operators.scan import detect_struct

    recs = list(BUILTIN.values())
    native = scan(people, exclude=["id", "n", "name"], recognizers=recs)
    key = lambda df: sorted((r.name, str(r.pii_analysis_result)) for r in df.collect())
    calls = spark.sparkContext.accumulator(0)

    def counted():
        fn = python_regex_factory(recs)()

        def batch(texts):
            calls.add(1)
            return fn(texts)

        return batch

    one = people.coalesce(1)
    assert key(scan(one, exclude=["id", "n", "name"], detector=register_batch_detector(python_regex_factory(recs)))) == key(native)
    rows = register_row_detector(counted)
    assert key(scan(one, exclude=["id", "n", "name"], row_detector=rows)) == key(native)
    assert calls.value == 1                                # all columns and rows of a batch in one call
    s = people.select(detect_struct(["note", "ph.one"], row_detector=rows).alias("s"))
    assert s.schema["s"].dataType.fieldNames() == ["note", "ph.one"] and s.count() == 3


def test_several_detectors_add_up(people):
    both = scan(people, exclude=["id", "n", "name"], detector=[python_regex_detector([BUILTIN["EMAIL_ADDRESS"]]), python_regex_detector([BUILTIN["IP_ADDRESS"]])])
    native = scan(people, exclude=["id", "n", "name"], recognizers=["EMAIL_ADDRESS", "IP_ADDRESS"])
    key = lambda df: sorted((r.name, str(r.pii_analysis_result)) for r in df.collect())
    assert key(both) == key(native)


def test_python_twin_validates_cards(spark):
    df = spark.createDataFrame([("4111111111111111 4111111111111112",)], "t string")
    r = df.select(python_regex_detector([BUILTIN["CREDIT_CARD"]])(F.col("t")).alias("s")).first().s
    assert [(x.start, x.end) for x in r] == [(0, 16)]


def test_recognisers_by_language(spark):
    recs = [BUILTIN["EMAIL_ADDRESS"].for_languages("en", "de"), BUILTIN["IP_ADDRESS"]]
    df = spark.createDataFrame([(1, "a@b.co 1.2.3.4", "en"), (2, "a@b.co 1.2.3.4", "fr"), (3, "a@b.co", None)], "id int, t string, lang string")
    s = scan(df, exclude=["id", "lang"], recognizers=recs, language="lang")
    got = {r.id: [x.entity_type for x in r.pii_analysis_result.analysis_results.t] for r in s.collect()}
    assert got == {1: ["EMAIL_ADDRESS", "IP_ADDRESS"], 2: ["IP_ADDRESS"], 3: []}
    with pytest.raises(ValueError):
        scan(df, recognizers=recs, language="lang", strategy="stacked")
