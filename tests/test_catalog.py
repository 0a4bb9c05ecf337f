"""Every catalog query against its SQL on DuckDB, and the shape of its plan."""

import os

import pytest

from compare import connect, difference
from daybook import catalog

FOLDER = os.environ.get("DAYBOOK_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_same_result(spark, con, key):
    assert difference(spark, con, FOLDER, key) is None


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_plan_has_no_pairing_and_no_python(spark, key):
    plan = catalog.queries()[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "InPandas"):
        assert word not in plan
