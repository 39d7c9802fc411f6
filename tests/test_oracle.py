"""Every registered query against its SQL, and what their plans must not contain."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from helpers import plan_of

from logweir.plans.catalog import QUERIES as CORE

QUERIES = {name: query for name, query in entry.queries().items() if name in CORE}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in CORE}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    assert differences(df, con, ORACLES[name]) is None
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_id", "status", "amount", "last_event_id"]
    assert df.count() > 0
