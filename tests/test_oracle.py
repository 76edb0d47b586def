"""Layer 2: every registered query against its DuckDB SQL on sf0.001."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import canon, duck
from plan_report import summarize
from tripmart.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(df.columns) == 28


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    plan = summarize(df._jdf.queryExecution().executedPlan().toString())
    assert plan["bad"] == 0, "nested-loop/cartesian join or Python evaluation in the plan"
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert canon(srows, df.columns) == canon(drows, dcols)
