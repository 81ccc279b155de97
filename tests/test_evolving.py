"""Landed JSON without a schema: the log, what is taken up at a restart, and that nothing is lost."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanmask.plans.config import ScanConfig
from spanmask.sources.evolving import CORRUPT, RESCUED, SchemaLog, evolve_schema, grow, ingest_json_evolving, parse_json_lines, read_evolved
from spanmask.sources.files import write_hop
from spanmask.streaming.hops import HopPaths, run_pipeline

D = T.StructType.fromDDL


def land(root, name, *lines):
    os.makedirs(f"{root}/landing", exist_ok=True)
    with open(f"{root}/landing/{name}.json", "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def start(spark, root, **options):
    return ingest_json_evolving(spark, f"{root}/landing", f"{root}/log", **options)


def run(stream, root):
    write_hop(stream, f"{root}/raw", f"{root}/ck").awaitTermination()


def records(spark, root):
    return {r.id: r for r in read_evolved(spark, f"{root}/raw", f"{root}/log").collect()}


def test_fields_grow_at_a_restart_and_types_stay(spark, tmp_path):
    root = str(tmp_path)
    land(root, 1, {"id": 1, "v": 1.5, "n": {"a": 1}}, {"id": 2, "v": 2})
    run(start(spark, root), root)
    land(root, 2, {"id": 3, "v": "x", "n": {"a": 2, "b": True}}, {"id": 4, "v": None, "new": "q"})
    second = start(spark, root)
    land(root, 3, {"id": 5, "late": [1, 2], "n": {"a": 1, "c": {"d": 1}}})
    run(second, root)
    got = records(spark, root)
    assert got[3].v is None and json.loads(got[3][RESCUED]) == {"v": "x"} and got[3].n.b is True
    assert got[4].new == "q" and got[4][RESCUED] is None and got[1].new is None
    rescued = json.loads(got[5][RESCUED])
    assert {k: json.loads(v) for k, v in rescued.items()} == {"late": [1, 2], "n": {"a": 1, "c": {"d": 1}}} and got[5].n.a == 1
    land(root, 4, {"id": 6, "late": [3], "n": {"c": {"d": 4}}})
    run(start(spark, root), root)
    got = records(spark, root)
    assert len(got) == 6 and got[6].late == [3] and got[6].n.c.d == 4 and got[6][RESCUED] is None and got[5].late is None
    versions = [T.StructType.fromJson(json.loads(v.schema)) for v in SchemaLog(spark, f"{root}/log").versions()]
    assert [f.name for f in versions[0].fields] == ["id", "n", "v"] and versions[-1]["v"].dataType == T.DoubleType()
    run(start(spark, root), root)                          # nothing landed: nothing read, no version
    assert len(records(spark, root)) == 6 and len(SchemaLog(spark, f"{root}/log").versions()) == len(versions)


SCHEMA = ("id bigint, v double, n struct<a: bigint, l: array<struct<x: bigint>>>, m array<bigint>")


@pytest.mark.parametrize("line,typed,rescued", [
    ('{"id": 1, "v": 2.5}', (1, 2.5, None, None), None),
    ('{"id": "1", "v": "x"}', (None, None, None, None), {"id": "1", "v": "x"}),
    ('{"id": null, "extra": null}', (None, None, None, None), None),
    ('{"id": 1.5, "m": [1, 2]}', (None, None, None, [1, 2]), {"id": "1.5"}),
    ('{"id": 1, "m": [1, "z"]}', None, {"m": '[1,"z"]'}),
    ('{"id": 1, "n": {"a": "z"}, "m": [3]}', None, {"n": '{"a":"z"}'}),
    ('{"id": 1, "n": {"a": 1, "l": [{"x": 1}, {"y": 2}]}}', None, {"n": '{"a":1,"l":[{"x":1},{"y":2}]}'}),
    ('{"id": 1, "n": [1]}', (1, None, None, None), {"n": "[1]"}),
    ('{"id": 1, "ID": 2, "é \'k\'": "ü"}', (1, None, None, None), {"ID": "2", "é 'k'": "ü"}),
    ('{}', (None, None, None, None), None),
])
def test_rescue(spark, line, typed, rescued):
    (r,) = parse_json_lines(spark.createDataFrame([(line,)], "value string"), D(SCHEMA)).collect()
    assert r[CORRUPT] is None
    got = r[RESCUED] and json.loads(r[RESCUED])
    assert (got and {k: v.replace(", ", ",").replace(": ", ":") for k, v in got.items()}) == rescued
    if typed:
        assert (r.id, r.v, r.n, r.m) == typed


def test_lines_that_are_no_records(spark):
    lines = ["", "  ", "not json", '{"id": 1', "[1]", "7", None]
    got = parse_json_lines(spark.createDataFrame([(x,) for x in lines], "value string"), D("id bigint")).collect()
    assert {r[CORRUPT] for r in got} == {"7", "[1]", "not json", '{"id": 1'} and len(got) == 4
    assert all(r.id is None and r[RESCUED] is None for r in got)


def test_growth_of_a_schema(spark):
    known = D("a int, s struct<x: int>, l array<struct<x: int>>")
    seen = D("A string, s struct<x: string, y: int>, l array<struct<z: int>>, file_path string, _rescued_data string, b string")
    assert grow(known, seen).simpleString() == "struct<a:int,s:struct<x:int,y:int>,l:array<struct<x:int,z:int>>,b:string>"
    assert grow(known, D("s int, l array<int>")) == grow(known, known)


def test_hints_names_of_one_spelling_and_an_empty_folder(spark, tmp_path):
    root = str(tmp_path)
    os.makedirs(f"{root}/landing")
    with pytest.raises(ValueError, match="landed"):
        evolve_schema(spark, f"{root}/landing", f"{root}/log")
    assert evolve_schema(spark, f"{root}/landing", f"{root}/log", hints=D("id string")) == D("id string")
    land(root, 1, {"id": 7, "Name": "a"}, {"id": 8, "name": "b"}, {"id": 9, "file_path": "c"})
    run(start(spark, root), root)
    rows = {r.id: r for r in read_evolved(spark, f"{root}/raw", f"{root}/log").collect()}
    assert set(rows) == {"7", "8", "9"} and rows["9"].file_path != "c" and json.loads(rows["9"][RESCUED]) == {"file_path": "c"}
    kept = [{rows[k].asDict().get("Name"), rows[k].asDict().get("name"), *json.loads(rows[k][RESCUED] or "{}").values()} - {None} for k in ("7", "8")]
    assert kept == [{"a"}, {"b"}]


def test_three_hops_without_a_schema(spark, scratch, tmp_path):
    root = str(tmp_path)
    conf = ScanConfig(ingestion_folder=f"{root}/landing", output_folder=f"{scratch}/out", cols_to_exclude=["id"], max_files=1)
    land(root, 1, {"id": 1, "t": "mail a@b.co"}, "broken x@y.org")
    run_pipeline(spark, conf)
    land(root, 2, {"id": 2, "t": "plain", "note": "10.0.0.1", "w": 3}, {"id": "no c@d.org", "t": None})
    run_pipeline(spark, conf)
    out = spark.read.option("mergeSchema", "true").parquet(HopPaths.under(conf.output_folder).anonymised)
    got = {(r.id, r.t, r.note, r[RESCUED], r[CORRUPT]) for r in out.collect()}
    assert got == {(1, "mail <EMAIL_ADDRESS>", None, None, None), (None, None, None, None, "broken <EMAIL_ADDRESS>"),
                   (2, "plain", "<IP_ADDRESS>", None, None), (None, None, None, '{"id":"no <EMAIL_ADDRESS>"}', None)}


def test_no_shuffle_on_the_way(spark):
    df = spark.createDataFrame([('{"id": 1}',)], "value string")
    plan = parse_json_lines(df, D(SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert parse_json_lines(df.where(F.lit(False)), D(SCHEMA)).count() == 0
