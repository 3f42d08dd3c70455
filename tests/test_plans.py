"""Physical-plan checks: pushdown, pruning, broadcast, top-k, no needless join."""

from __spark_entry__ import queries
from fixtures import SF_MID


def plan(spark, name):
    df = queries()[name](spark, SF_MID)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_hour_report_prunes_and_pushes(spark):
    p = plan(spark, "demand_by_hour")
    assert "Join" not in p  # no dimension join where no name is needed
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in p and "LessThan(ts,2025-01-01T00:00)" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in p


def test_top_zones_joins_after_aggregating_and_uses_top_k(spark):
    p = plan(spark, "top_zones")
    assert "BroadcastHashJoin" in p and "LeftOuter" in p
    assert "TakeOrderedAndProject" in p
    # the join input on the fact side is the per-place aggregate, not trip rows
    join_at = p.index("BroadcastHashJoin")
    assert "HashAggregate" in p[join_at:]


def test_payment_report_reads_only_needed_columns(spark):
    p = plan(spark, "tips_by_payment")
    assert "props" not in p and "user_id" not in p
