"""The physical plans: no pairs of everything, pushed filters, map-side reduction."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lodestrata.operators import history
from lodestrata.plans.registry import table
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


CHECKED = [
    "loss_ratio_by_type", "high_risk_policies", "customer_360", "scd2_merge", "change_feed", "glossary_auto_links",
    "alert_routing", "domain_health", "platform_health", "lapse_risk", "compliance_scorecard", "nearest_vectors",
    "deployment_gate", "executive_summary", "semantic_measures", "governance_tile", "schedule_decision",
]


@pytest.mark.parametrize("name", CHECKED)
def test_no_nested_loops_or_python(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert word not in text


def test_filters_and_columns_reach_the_scan(spark, sf):
    df = table(spark, sf, "events").filter("event_type = 'error'").groupBy("user_id").agg(F.count("*").alias("n"))
    text = plan(df)
    assert "EqualTo(event_type,error)" in text
    assert "props" not in text.split("ReadSchema:")[1].split("\n")[0]


def test_keep_latest_reduces_before_the_shuffle(spark, sf):
    df = history.keep_latest(table(spark, sf, "orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")])
    text = plan(df)
    assert text.count("WindowGroupLimit") >= 2  # partial before the exchange, final after it


def test_mutations_need_no_shuffle(spark, sf):
    df = history.conditional_update(table(spark, sf, "orders"), F.col("o_orderkey") > 5, {"o_orderstatus": F.lit("X")})
    assert "Exchange" not in plan(df)


def test_retention_reaches_the_scan(spark, sf):
    as_of = F.lit("2001-08-02").cast("timestamp_ntz")
    kept, expired = history.split_expired(table(spark, sf, "orders"), "o_orderdate", as_of, 1000)
    assert "LessThan(o_orderdate" in plan(expired)
    assert "IsNull(o_orderdate)" in plan(kept) and "GreaterThanOrEqual(o_orderdate" in plan(kept)
    gone = history.conditional_delete(table(spark, sf, "orders"), F.col("o_orderkey") > 100)
    assert "LessThanOrEqual(o_orderkey,100)" in plan(gone)


def test_stored_profiles_hold_no_column_in_one_task(spark, sf):
    """A percentile in a global aggregate sends every distinct value to one task."""
    plan = entry.queries()["stored_profiles"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan


def test_glossary_links_sort_no_grams_and_broadcast_no_inventory(spark, sf):
    """Sorted by name, the grams of all names of a task filled its memory; the table of counts must not be a column either."""
    execution = entry.queries()["glossary_auto_links"](spark, sf)._jdf.queryExecution()
    physical, optimized = execution.executedPlan().toString(), execution.optimizedPlan().toString()
    assert "SortAggregate" not in physical and "min(struct(" not in physical
    assert "leftHint=(strategy=merge)" in optimized or "rightHint=(strategy=merge)" in optimized
    assert not [line for line in optimized.split("\n") if "Project [inner" in line and "_counts" in line]
