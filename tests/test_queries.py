"""Every registered query against its DuckDB oracle (the driver's check), at sf0.001."""

import pytest

import __spark_entry__ as E
from check_queries import compare

from conftest import SF_SMALL


def test_contract():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 50


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema] == ["region_id", "class", "n_pixels"]


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)
    assert res[name][0] == "OK", res[name]
