"""Every registered query against its SQL on the smallest test data."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registered  # noqa: E402
from newstide.checks.registry import CHECKS  # noqa: E402
from check_queries import compare, connect  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def stays_in_the_jvm(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_equals_sql(spark, connection, name):
    problem, found, _ = compare(spark, connection, FOLDER, name, stays_in_the_jvm)
    assert problem is None, problem
    assert found > 0


def test_every_query_has_sql_and_entry_runs(spark):
    assert set(CHECKS) <= set(registered.oracle_sql()) <= set(registered.queries())
    assert registered.entry(spark).count() > 0
