"""Every registered query against its DuckDB twin on sf0.001."""

import pytest

from conftest import SF0001


def _queries():
    import __spark_entry__ as E

    return E.queries(), E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from check_oracle import duck as mk

    return mk(SF0001)


@pytest.mark.parametrize("name", sorted(_queries()[0]))
def test_query_matches_oracle(spark, duck, name):
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from check_oracle import compare

    qs, sqls = _queries()
    r = compare(spark, duck, name, qs[name], sqls.get(name), SF0001)
    if sqls.get(name) is None:
        assert r["rows"] > 0
    else:
        assert r["cols_ok"] and r["values_ok"], r


def test_entry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["doc_id", "text"] and df.count() == 200
