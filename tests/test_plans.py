"""Shapes of physical plans that matter at scale."""

import re

import pytest

import __spark_entry__ as registered

SF = "/root/testdata/sf0.001"
STREAMED = {name for name in registered.queries() if "stream" in name or name in (
    "land_events", "land_events_json", "admit_batches", "upsert_history", "increment_counters", "bloom_counters"
)}


def _plan(spark, name):
    frame = registered.queries()[name](spark, SF)
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registered.queries()) - STREAMED))
def test_no_query_pairs_everything_with_everything(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "name, exchanges",
    [
        ("filter_event_type", 0), ("grid_cell", 0), ("coerce_cells", 1), ("heatmap_hourly", 1), ("heatmap_daily", 2),
        ("backfill_range", 1), ("decode_or_skip", 0), ("dedup_stats", 2), ("daily_song_counts", 2),
        ("apply_status_events", 1), ("latest_row_per_key", 1), ("due_work", 1), ("expire_history", 0),
    ],
)
def test_number_of_shuffles(spark, name, exchanges):
    assert len(re.findall(r"Exchange hashpartitioning", _plan(spark, name))) == exchanges


@pytest.mark.parametrize("name", ["user_topk", "recent_buckets_hourly", "latest_row_per_key", "raw_song_counts", "dedup_batches"])
def test_rows_are_cut_before_the_ranking_shuffle(spark, name):
    plan = _plan(spark, name)
    limit, shuffle = plan.index("Final"), plan.index("Partial")
    assert "Exchange hashpartitioning" in plan[limit:shuffle]


@pytest.mark.parametrize("name", ["heatmap_hourly", "daily_song_counts", "dedup_stats", "apply_status_events", "bloom_skip"])
def test_partial_aggregates_come_before_the_shuffle(spark, name):
    plan = _plan(spark, name)
    for part in plan.split("Exchange hashpartitioning")[1:]:
        assert re.search(r"partial_|HashAggregate\(keys", part.split("\n")[1])


def test_only_needed_columns_are_read(spark):
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>" in _plan(spark, "duplicate_link_owners")
    assert "value" not in _plan(spark, "heatmap_hourly").split("ReadSchema")[1]
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in _plan(spark, "dedup_stats")
