"""Every registered query against its SQL, and the rules registered queries keep."""

from __future__ import annotations

import pytest
from conftest import SMALL

import __spark_entry__ as driver
import verify
from settle.plans.catalogue import CATALOGUE

SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return verify.oracle(SMALL)


def test_every_query_has_sql():
    assert set(CATALOGUE) <= set(SQL) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query_matches_its_sql(spark, duck, name):
    same, detail = verify.compare(spark, duck, SMALL, name, SQL[name])
    assert same, detail


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns[:3] == ["window_start_us", "window_end_us", "published"]
    assert result.count() == 58


@pytest.mark.parametrize("name", sorted(n for n in CATALOGUE if not n.startswith("stream_")))
def test_plans_stay_in_the_jvm_and_never_cross_join(spark, name):
    plan = CATALOGUE[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        if operator == "SinglePartition" and name == "freshness":
            continue  # one row out of one row a minute
        assert operator not in plan, operator
