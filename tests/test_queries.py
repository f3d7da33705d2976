"""Every registered query against DuckDB on the smallest tables; no Python and no cross joins in its plan."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import connect, differences
from odsflow.plans import load_oracles, load_queries, oracles, queries as base_queries

ORACLES = {**oracles.ORACLES, **load_oracles.ORACLES}
QUERIES = {**base_queries.QUERIES, **load_queries.QUERIES}
WITHOUT_SQL = {"stream_count_or_time_flush"}  # compared with plain Python in test_loads


@pytest.fixture(scope="module")
def duck(folder_path="/root/testdata/sf0.001"):
    return connect(folder_path)


def test_every_query_has_its_sql():
    assert set(QUERIES) - WITHOUT_SQL == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry_returns_days(spark):
    result = entry(spark)
    assert result.columns == ["order_date", "order_cnt", "total_amount", "success_order_cnt"]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, folder, name):
    result = QUERIES[name](spark, folder)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    assert differences(result, duck, ORACLES[name]) == []
