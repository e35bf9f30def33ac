"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from pulsechecks import catalog, compare
from tests.conftest import SF

catalog.load()


@pytest.fixture(scope="module")
def con():
    connection = compare.connect(SF)
    yield connection
    connection.close()


# Queries that write files run their jobs while they are built; only their reads would show in a plan.
WRITES = tuple(f"s{n}_" for n in range(1, 14))
# Python in the plan, and joins without an equality.
UNWANTED = ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct",
            "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, con, key):
    df = catalog.QUERIES[key](spark, SF)
    ok, text = compare.compare_frame(df, con, key)
    assert ok, text
    if not key.startswith(WRITES):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [word for word in UNWANTED if word in plan]


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
