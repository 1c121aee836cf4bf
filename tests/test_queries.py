"""Registered queries against the oracle, and the shape of their plans."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from compare import differences, oracle_rows

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    found = QUERIES[name](spark, FOLDER)
    names, rows, _ = oracle_rows(ORACLES[name], FOLDER)
    assert differences(found.columns, [tuple(r) for r in found.collect()], names, rows) is None


def test_entry(spark):
    assert driver.entry(spark).count() == 15


@pytest.mark.parametrize("name", ["flow_feature_table", "flow_alerts", "rule_alerts", "flow_stats_10s", "bandwidth", "alerts_union", "forecast_anomalies", "variance_anomalies"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("name", ["flow_feature_table", "packet_gaps"])
def test_rows_are_shuffled_once_where_no_flow_is_large(spark, name):
    """Once the list of large flows turns out empty, their branch and its scans go."""
    rows = QUERIES[name](spark, FOLDER)
    rows.collect()
    final = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1 and final.count("FileScan") == 1


@pytest.mark.parametrize("name, count", [("rule_classify", 0), ("rule_alerts", 0), ("detected_alerts", 0), ("bandwidth", 1), ("flow_stats_10s", 1)])
def test_shuffles(spark, name, count):
    assert exchanges(QUERIES[name](spark, FOLDER)) == count


def test_scans_read_only_what_is_needed(spark):
    plan = QUERIES["bandwidth"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("ReadSchema"):]
    assert "event_id" not in scan and "value" not in scan
