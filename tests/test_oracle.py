"""Every registered query against its SQL on the smallest tables, and a look at its plan."""

import os

import pytest

from checks import ORACLES, QUERIES
from tests.oracle import compare, connect

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
NAMES = list(QUERIES)
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")

    def checked(session, sf):
        df = QUERIES[name](session, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [word for word in FORBIDDEN if word in plan]
        return df

    if name in ORACLES:
        report, rows = compare(spark, con, SF, checked, ORACLES[name])
        assert report is None
    else:
        assert checked(spark, SF).count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["hour_ts", "pulocationid", "demand", "avg_trip_distance", "avg_total_amount"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
