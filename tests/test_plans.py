"""Shape of the plans that must hold at scale."""

import pytest
from conftest import SF_DIR, plan_of

import __spark_entry__ as contract
from roomtide.operators.joins import events_within, join_unique
from roomtide.runtime import cut_lineage, shared_folder

# These run jobs while they are built; the job tests look at them.
JOBS = {
    "archived_days", "nightly_slice", "live_routing", "live_stream_whales", "nightly_run", "nightly_quarantine", "local_run",
    "registry_stream", "archive_stream", "pipeline", "live_view_whales", "live_view_streaks", "live_view_verticals",
    "live_retention", "probation_stream", "registry_snapshot", "catalog_tables", "distinct_stream",
    "session_summary_stream", "likes_by_stretch", "quarantine_repaired",
}


@pytest.mark.parametrize("name", sorted(q for q in set(contract.queries()) - JOBS if not q.startswith("op")))
def test_no_python_and_no_cross_join(name, spark):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_the_named_checkpoint_folder_is_used(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    cut_lineage(spark.range(3))
    assert folder in spark.sparkContext.getCheckpointDir()


@pytest.mark.parametrize("name", [
    "session_summary", "probation_gate", "heartbeat_rollup", "event_overview", "registry_state", "registry_state_max",
    "spider_registry", "spider_discoveries",
])
def test_event_aggregates_hash(name, spark):
    assert "SortAggregate" not in plan_of(contract.queries()[name](spark, SF_DIR))


def test_the_payload_is_parsed_once(spark):
    plan = plan_of(contract.queries()["whale_analytics"](spark, SF_DIR))
    assert plan.count("json_tuple(") == 1 and "from_json" not in plan


def test_copies_of_spans_are_not_broadcast(spark):
    """40,000 sessions of 20 hours are small by Spark's estimate and millions of rows once they are laid on buckets."""
    sessions = spark.range(40_000).selectExpr(
        "concat('s', id % 500) as streamer", "timestamp '2024-01-01 00:00:00' + make_dt_interval(0, id % 24) as session_start",
        "timestamp '2024-01-01 20:00:00' + make_dt_interval(0, id % 24) as session_end",
    )
    events = spark.range(1000).selectExpr("concat('s', id % 500) as streamer", "timestamp '2024-01-01 12:00:00' as ts")
    joined = events_within(events, sessions, key="streamer", ts="ts", start="session_start", end="session_end", bucket_seconds=600)
    assert "SortMergeJoin" in plan_of(joined) and "BroadcastHashJoin" not in plan_of(joined)
    joined.collect()
    assert "BroadcastHashJoin" not in plan_of(joined)


def test_a_hot_key_keeps_its_rows_whatever_the_salts(spark):
    events = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('s', id % 7)) as k", "timestamp_seconds(id) as ts")
    spans = spark.createDataFrame([("hot", 10, 500), ("hot", 400, 900), ("s1", 0, 3000)], "k string, a long, b long").selectExpr(
        "k", "timestamp_seconds(a) as a", "timestamp_seconds(b) as b"
    )
    expected = events.crossJoin(spans.withColumnRenamed("k", "k2")).where("k = k2 and ts between a and b").count()
    for salts in (1, 8):
        got = events_within(events, spans, key="k", ts="ts", start="a", end="b", bucket_seconds=60, salts=salts)
        assert got.count() == expected > 0
        names = spans.select("k").distinct()
        assert join_unique(events, names, "k", ["ts"], salts=salts).count() == events.join(names, "k").count()
