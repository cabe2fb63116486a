import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
"""Every SQL-checkable registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck, type_mismatches

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = E.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    msg = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert msg is None, msg
    types = type_mismatches(df.schema, con.sql(ORACLES[name]).to_arrow_table().schema)
    assert not types, types


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "segment", "recommended_action", "action_cost",
                          "expected_clv_saved", "roi", "churn_probability", "cumulative_cost"]
    assert df.count() >= 0


def test_every_query_has_callable():
    assert set(ORACLES) <= set(E.queries())
