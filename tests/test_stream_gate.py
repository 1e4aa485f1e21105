"""The gate on a running stream against the gate over the whole."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import event, plan_of
from pyspark.sql import functions as F

from roomtide.operators.gate import qualify
from roomtide.schemas import ENVELOPE
from roomtide.streaming.gate import add_batch, control_messages, late_events, start_gate, verdicts, watched, watermark

ZERO = datetime(2024, 1, 1)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def iso(seconds):
    return (ZERO + timedelta(seconds=seconds)).isoformat(timespec="microseconds") + "+00:00"


def made(seed, length):
    rng = random.Random(seed)
    for at in sorted(rng.uniform(0, length) for _ in range(500)):
        kind = rng.choice(["gift", "comment", "comment", "like", "room_users", "product_pin"])
        data = {"gift": '{"diamond_count":2,"repeat_count":3}', "like": '{"batch_count":4}', "room_users": f'{{"viewer_count":{rng.randrange(12)}}}'}
        yield event(kind, data.get(kind, "{}"), streamer=rng.choice(["hot", "hot", "a", "b"]), category=rng.choice(["npc", "ecommerce"]), at=iso(at))


def sessions_of(spark, length):
    rows_, rng = [], random.Random(9)
    for name in ("hot", "a", "b", "silent"):
        at = rng.uniform(0, 100)
        while at < length:
            end = at + rng.choice([20, 90, 400])
            rows_.append((name, rng.choice(["npc", "ecommerce"]), ZERO.replace(tzinfo=timezone.utc) + timedelta(seconds=at), ZERO.replace(tzinfo=timezone.utc) + timedelta(seconds=end)))
            at = end + rng.uniform(5, 200)
    return spark.createDataFrame(rows_, "streamer string, category string, session_start timestamp, session_end timestamp")


def stream_parts(spark, parts, root, **more):
    late = 0
    for part in parts:
        part.write.mode("append").parquet(f"{root}/in")
        query = start_gate(spark.readStream.schema(ENVELOPE).parquet(f"{root}/in"), f"{root}/out", f"{root}/c", **more)
        query.awaitTermination()
        late += late_events(query)
    return late


@pytest.mark.parametrize("salts", [1, 4])
def test_verdicts_equal_the_gate_over_the_whole(spark, tmp_path, envelope, salts):
    length, sessions = 3000, sessions_of(spark, 3000)
    env = envelope(*made(1, length))
    messages = env.unionByName(control_messages(sessions)).cache()
    cuts = ["", iso(1000), iso(2000), "9"]
    parts = [messages.where((F.col("received_at") >= a) & (F.col("received_at") < b)) for a, b in zip(cuts, cuts[1:])]
    root = str(tmp_path)
    expected = qualify(env, sessions)
    for k, part in enumerate(parts):
        assert stream_parts(spark, [part], root, delay="0 seconds", salts=salts) == 0
        decided = watermark(spark, f"{root}/c")
        got = verdicts(spark, f"{root}/out", decided)
        over = F.col("session_start") + F.expr("interval 90 seconds")
        due = expected.where(over < F.lit(decided))
        # A session that goes on has no end yet; all else is final.
        assert rows(got.drop("session_end")) == rows(due.drop("session_end")) and (k == 0 or due.count() > 5)
    stream_parts(spark, [envelope(event("tick", "{}", at="2030-01-01T00:00:00Z"))], root, delay="0 seconds", salts=salts)
    final = verdicts(spark, f"{root}/out", watermark(spark, f"{root}/c"))
    assert rows(final) == rows(expected) and final.where("streamer = 'silent'").count() > 0


def test_late_events_are_counted_and_state_is_let_go(spark, tmp_path, envelope):
    root = str(tmp_path)
    start = spark.createDataFrame([("s", "npc", ZERO.replace(tzinfo=timezone.utc), None)], "streamer string, category string, session_start timestamp, session_end timestamp")
    first = control_messages(start).unionByName(envelope(event("comment", "{}", streamer="s", at=iso(10)), event("comment", "{}", streamer="s", at=iso(5000))))
    late = envelope(event("comment", "{}", streamer="s", at=iso(20)), event("comment", "{}", streamer="s", at=iso(5001)))
    assert stream_parts(spark, [first], root, delay="10 seconds") == 0
    late.coalesce(1).write.mode("append").parquet(f"{root}/in")
    query = start_gate(spark.readStream.schema(ENVELOPE).parquet(f"{root}/in"), f"{root}/out", f"{root}/c", delay="10 seconds")
    query.awaitTermination()
    assert late_events(query) == 1
    state = query.recentProgress[-1]["stateOperators"][0]
    assert state["numRowsTotal"] <= 2  # the two events of the last ten seconds
    (row,) = verdicts(spark, f"{root}/out", watermark(spark, f"{root}/c")).collect()
    assert (row.comments, row.session_end) == (1, None)


def test_a_replayed_batch_changes_nothing(spark, tmp_path, envelope):
    root = str(tmp_path)
    at = ZERO.replace(tzinfo=timezone.utc)
    batch = spark.createDataFrame(
        [("s", "npc", at, None, True, "comment", None, None, None, None), ("s", "npc", at, None, True, "room_users", None, None, 7, None)],
        "streamer string, category string, session_start timestamp, session_end timestamp, started boolean, event_type string, repeat_count bigint, coins bigint, viewers bigint, taps bigint",
    )
    for number in (0, 0, 1):
        add_batch(batch, number, root)
    (row,) = verdicts(spark, root, datetime(2024, 1, 2, tzinfo=timezone.utc)).collect()
    assert (row.comments, row.viewers) == (2, 7)
    assert watermark(spark, str(tmp_path / "none")).year == 1970


def test_events_meet_only_starts_near_them(spark, envelope):
    """1,000 sessions of one streamer and an event of each: joined on the streamer alone, each event met all starts."""
    sessions = spark.range(1000).select(
        F.lit("hot").alias("streamer"), F.lit("npc").alias("category"), F.timestamp_seconds(F.col("id") * 1000).alias("session_start"),
        F.timestamp_seconds(F.col("id") * 1000 + 500).alias("session_end"),
    )
    comments = sessions.select(
        "streamer", "category", F.lit("npc").alias("archetype"), F.lit("comment").alias("event_type"),
        F.date_format(F.col("session_start") + F.expr("interval 90 seconds"), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("received_at"), F.lit("{}").alias("data"),
    )
    rows_ = watched(comments.unionByName(control_messages(sessions)))
    assert rows_.where("event_type = 'comment'").count() == 1000  # the probation's end included
    keys = next(line for line in plan_of(rows_).splitlines() if "Join" in line)
    assert "_of_bucket" in keys.split("LeftOuter")[0]
