"""The physical plans are the ones that scale."""

import os

import pytest

from headway.plans import registry, roles

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables here")


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_filters_and_columns_reach_the_scan(spark):
    e = roles.table(spark, DATA, "events").filter("event_type = 'click'").select("event_id")
    text = plan(e)
    assert "EqualTo(event_type,click)" in text and "ReadSchema: struct<event_id:bigint,event_type:string>" in text


def test_reference_tables_are_broadcast(spark):
    text = plan(registry.QUERIES["trip_enrichment"](spark, DATA))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_latest_per_key_combines_before_it_moves(spark):
    text = plan(registry.QUERIES["latest_per_key"](spark, DATA))
    assert "partial_max_by" in text and "Window" not in text


@pytest.mark.parametrize("name", ["last_position_asof", "pair_near", "min_sequence_in_window", "adjacent_pairs", "cooldown_alerts", "neighborhood_join"])
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(registry.QUERIES[name](spark, DATA))
    assert not any(bad in text for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"))
