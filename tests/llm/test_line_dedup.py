import pytest
from pyspark.sql import functions as F

from spanmask.llm.line_dedup import drop_boilerplate


def test_small(spark):
    pages = [(i, f"Menu\nbody {i}\n\n Menu \nFooter {i % 2}", "a") for i in range(20)] + [(100 + i, "Menu\nonly here", "b") for i in range(4)]
    pages += [(200, None, "a"), (201, "", None), (202, "x", "")]
    df = spark.createDataFrame(pages, "doc_id long, text string, source string")
    with pytest.raises(ValueError, match="n_lines"):
        drop_boilerplate(df.withColumn("N_lines", F.lit("clash")))
    rows = {r.doc_id: r for r in drop_boilerplate(df, ratio=0.6).collect()}
    assert len(rows) == len(pages)
    assert rows[3].text == "body 3\n\nFooter 1" and (rows[3].n_lines, rows[3].n_dropped) == (4, 2)
    kept = drop_boilerplate(df.withColumn("n_lines", F.lit("own")), ratio=0.6, counts=False).collect()
    assert {r.n_lines for r in kept} == {"own"} and {r.doc_id: r.text for r in kept} == {i: r.text for i, r in rows.items()}
    assert rows[100].text == "Menu\nonly here" and rows[200].text is None and rows[201].text == ""
    assert rows[200].n_lines == 0


def test_copies_of_a_page_are_one_page_with_fold(spark):
    rows = [(i, "copied line\nand another\nMenu", "a") for i in range(30)] + [(100 + i, f"own {i}\nMenu", "a") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plain = {r.doc_id: r.text for r in drop_boilerplate(df, ratio=0.5).collect()}
    assert plain[0] == "" and plain[103] == "own 3"
    got = {r.doc_id: r.text for r in drop_boilerplate(df, ratio=0.5, fold=True).collect()}
    assert got[0] == "copied line\nand another" and got[103] == "own 3"


def test_line_on_just_under_a_tenth_of_the_pages(spark):
    rows = []
    for h in range(4):                                   # 19 of 200 pages have the line, 10 of 200 (5 %) a phrase
        for i in range(200):
            lines = [f"body {h} {i}"] + ["Subscribe to our letter"] * (i % 10 == 3 and i > 3) + ["as they say"] * (i % 20 == 7)
            rows.append((1000 * h + i, "\n".join(lines), f"host{h}"))
    got = drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sum(r.n_dropped for r in got) == 4 * 19 and not any("Subscribe" in r.text for r in got)
    assert sum("as they say" in r.text for r in got) == 4 * 10


def test_empty_and_odd(empty, odd):
    assert drop_boilerplate(empty).collect() == []
    assert drop_boilerplate(odd).count() == 6


def test_no_python_in_the_plan(docs):
    plan = drop_boilerplate(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
