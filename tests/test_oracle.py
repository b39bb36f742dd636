"""Every query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as driver
from tickframe import registry
from tools import compare

from .conftest import SMALL

# No supplier of the smallest tables has a negative balance.
MAY_BE_EMPTY = {"orphan_bars"}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


# Joins that pair all rows, and rows that leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow", "Scan ExistingRDD")
# Their results are put together on the driver: one row per setting, or per signal.
FROM_DRIVER = {"lem_cv", "feature_importance", "importance_checks", "lem_stump_importance", "seed_stocks"}


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert name in FROM_DRIVER or not [word for word in UNWANTED if word in plan]
    good, note = compare.compare(spark, duck, name, SMALL, df)
    assert good or (name in MAY_BE_EMPTY and "rows 0 / 0" in note), note


def test_every_statement_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 10
