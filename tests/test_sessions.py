import json
import random
from datetime import datetime, timedelta

import pytest
from conftest import event, plan_of
from pyspark.sql import functions as F

from roomtide.operators.gate import probation_events, qualify
from roomtide.operators.joins import events_within
from roomtide.operators.sessions import carry_like_total, derive_sessions, session_summary, session_top
from roomtide.operators.telemetry import breakdown, heartbeat, implausible
from roomtide.streaming.heartbeat import count_batch, read_heartbeat

START = datetime(2024, 1, 1)


def at(seconds):
    return (START + timedelta(seconds=seconds)).isoformat() + "+00:00"


def gift(seconds, user="u", name="g", diamonds=1, repeat=1, streaking=False, usd=None, **kwargs):
    data = dict(unique_id=user, gift_name=name, diamond_count=diamonds, repeat_count=repeat, streaking=streaking, usd_value=usd)
    return event("gift", json.dumps(data), at=at(seconds), **kwargs)


def room(seconds, viewers, **kwargs):
    return event("room_users", json.dumps({"viewer_count": viewers}), at=at(seconds), **kwargs)


def comment(seconds, **kwargs):
    return event("comment", "{}", at=at(seconds), **kwargs)


@pytest.fixture
def spans(spark):
    """(streamer, category, start second, end second) as sessions."""
    schema = "streamer string, category string, session_start timestamp_ntz, session_end timestamp_ntz"

    def make(*rows):
        moved = [(s, c, START + timedelta(seconds=a), START + timedelta(seconds=b)) for s, c, a, b in rows]
        df = spark.createDataFrame(moved, schema)
        return df.withColumns({c: F.col(c).cast("timestamp") for c in ("session_start", "session_end")})

    return make


def test_summary(envelope):
    env = envelope(
        gift(0, diamonds=10, repeat=2), gift(30, diamonds=100, streaking=True), gift(60, diamonds=4, usd=1.5),
        room(10, 50), room(90, 40), comment(5), comment(6),
        event("like", '{"total_room_likes":7}', at=at(20)), event("like", "{}", at=at(120)),
    )
    row = session_summary(env).first()
    assert (row.total_diamonds, row.total_usd, row.total_comments) == (24, 1.5 + 20 * 0.005, 2)
    assert (row.last_viewer_count, row.total_likes, row.duration_seconds) == (40, 7, 120.0)
    assert (row.diamonds_per_min, row.usd_per_min) == (12.0, (1.5 + 20 * 0.005) / 2)


def test_burn_rate_without_duration_is_zero(envelope):
    row = session_summary(envelope(gift(0, diamonds=10))).first()
    assert (row.diamonds_per_min, row.usd_per_min) == (0.0, 0.0)


def test_summary_per_session(envelope, spans):
    env = envelope(gift(0), gift(100), gift(101), gift(7300), gift(9000))
    got = session_summary(env, spans(("s1", "npc", 0, 100), ("s1", "npc", 101, 8000), ("s2", "npc", 0, 9)))
    assert sorted((r.total_diamonds, r.duration_seconds) for r in got.collect()) == [
        (0, 9.0), (2, 100.0), (2, 7899.0)
    ]


def test_top_lists(envelope):
    env = envelope(
        *[gift(i, user=f"u{i}", name=f"g{i}", diamonds=i + 1, repeat=2) for i in range(7)],
        gift(50, user="u0", name="g0", diamonds=500, streaking=True), gift(51, user="u9", name="g9", diamonds=7, repeat=2),
    )
    whales = session_top(env, "gifter").orderBy("rank").collect()
    assert [(r.gifter, r.diamonds, r.approx_usd) for r in whales] == [("u6", 14, 0.07), ("u9", 14, 0.07), ("u5", 12, 0.06)]
    gifts = session_top(env, "gift").orderBy("rank").collect()
    assert [(r.gift_name, r.times) for r in gifts] == [(f"g{i}", 2) for i in range(5)]
    assert len(session_top(env, "gift", n=2).collect()) == 2
    assert plan_of(session_top(env, "gift")).count("WindowGroupLimit") == 2
    with pytest.raises(ValueError):
        session_top(env, "other")


def test_session_bounds_against_a_plain_walk(spark, envelope):
    rng = random.Random(5)
    times = {s: sorted(rng.sample(range(0, 200_000), 300)) for s in ("a", "b")}
    env = envelope(*[comment(t, streamer=s) for s, ts in times.items() for t in ts])
    expected = set()
    for s, ts in times.items():
        first = last = ts[0]
        for t in [*ts[1:], 10**9]:
            if t - last > 900:
                expected.add((s, first, last))
                first = t
            last = t
    got = derive_sessions(env).select(
        "streamer", F.col("session_start").cast("timestamp_ntz"), F.col("session_end").cast("timestamp_ntz")
    )
    assert {(r[0], int((r[1] - START).total_seconds()), int((r[2] - START).total_seconds())) for r in got.collect()} == expected


def test_a_pause_of_exactly_the_gap_does_not_end_a_session(envelope):
    assert derive_sessions(envelope(comment(10), comment(910))).count() == 1
    assert derive_sessions(envelope(comment(10), comment(911))).count() == 2


def test_range_join_against_brute_force(spark):
    rng = random.Random(6)
    events = [(rng.choice(["hot", "hot", "x"]), rng.randrange(3000), i) for i in range(600)]
    spans = [(rng.choice(["hot", "x", "y"]), a := rng.randrange(3000), a + rng.randrange(-5, 200), i) for i in range(40)]
    expected = sorted((e[2], s[3]) for e in events for s in spans if e[0] == s[0] and s[1] <= e[1] <= s[2])
    left = spark.createDataFrame(events, "k string, t bigint, e bigint").withColumn("ts", F.timestamp_seconds("t")).drop("t")
    right = spark.createDataFrame(spans, "k string, a bigint, b bigint, s bigint").select(
        "k", "s", F.timestamp_seconds("a").alias("a"), F.timestamp_seconds("b").alias("b")
    )
    for width in (7, 90, 5000):
        got = events_within(left, right, key="k", ts="ts", start="a", end="b", bucket_seconds=width)
        assert sorted((r.e, r.s) for r in got.collect()) == expected


@pytest.mark.parametrize("bucket_seconds", [1, 60, 86_400])
def test_carried_total_against_a_plain_walk(spark, bucket_seconds):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), t // 3, t, rng.choice([None, None, t])) for t in range(400)]
    expected, last = {}, {}
    for streamer, _, number, total in rows:
        last[streamer] = total if total is not None else last.get(streamer, 0)
        expected[number] = last[streamer]
    df = spark.createDataFrame(rows, "streamer string, t bigint, number bigint, total_room_likes bigint").select(
        "streamer", F.timestamp_seconds("t").alias("event_timestamp"), "number", "total_room_likes"
    )
    got = carry_like_total(df, bucket_seconds, tie_break=("number",))
    assert {r.number: r.total_room_likes for r in got.collect()} == expected


@pytest.mark.parametrize(
    "category, events, passed",
    [
        ("npc", [room(1, 5), gift(2, streaking=True)], True),
        ("npc", [room(1, 4), gift(2)], False),
        ("npc", [room(1, 9), comment(2), comment(3)], False),
        ("npc", [room(1, 9), comment(2), comment(3), comment(90)], True),
        ("npc", [room(1, 9), comment(2), comment(3), comment(91)], False),
        ("npc", [room(91, 9), gift(2)], False),
        ("ecommerce", [event("product_pin", "{}", at=at(3))], True),
        ("ecommerce", [room(1, 5), comment(2)], True),
        ("ecommerce", [room(1, 5), gift(2)], False),
        ("npc", [], False),
    ],
)
def test_gate(envelope, spans, category, events, passed):
    (row,) = qualify(envelope(*events), spans(("s1", category, 0, 200))).collect()
    assert row.is_qualified is passed


def test_gate_needs_a_lasting_session(envelope, spans):
    env = envelope(room(1, 50), gift(2))
    assert qualify(env, spans(("s1", "npc", 0, 89))).count() == 0
    assert qualify(env, spans(("s1", "npc", 0, 90))).count() == 1
    assert qualify(env, spans(("s1", "npc", 0, 90)), enabled=False).count() == 0


def test_gate_counts_and_its_registry_event(envelope, spans):
    env = envelope(room(1, 6), room(5, 9), gift(2, diamonds=3, repeat=4, streaking=True), gift(3, diamonds=1),
                   event("like", '{"batch_count":8}', at=at(9)), event("like", "{}", at=at(9)), comment(4))
    verdict = qualify(env, spans(("s1", "npc", 0, 200)))
    row = verdict.first()
    assert (row.viewers, row.gifts, row.diamonds, row.comments, row.likes) == (9, 5, 13, 1, 9)
    made = probation_events(verdict).first()
    assert (made.handle, made.op, made.passed, made.diamonds) == ("s1", "probation", True, 13)


def test_overlapping_sessions_of_one_streamer_are_judged_apart(envelope, spans):
    env = envelope(room(50, 9), gift(60))
    got = qualify(env, spans(("s1", "npc", 0, 500), ("s1", "npc", 55, 500), ("s1", "npc", 300, 500)))
    found = {r.session_start.minute * 60 + r.session_start.second: (r.viewers, r.gifts) for r in got.collect()}
    assert found == {0: (9, 1), 55: (0, 1), 300: (0, 0)}


def test_heartbeat(envelope):
    env = envelope(gift(10), comment(20, streamer="s2"), gift(700), event("battle", "{}", at=at(15)))
    beats = heartbeat(env).orderBy("window_start").collect()
    assert [(r.total_events, r.gift_total, r.comment_total, r.active_streamers) for r in beats] == [
        (2, 1, 1, 2), (2, 1, 1, 0), (3, 2, 1, 1),
    ]
    assert [r.uptime_seconds for r in beats] == [290.0, 590.0, 890.0]
    assert beats[0].eps == 2 / 290
    assert {(r.event_type, r.total) for r in breakdown(heartbeat(env)).collect()} == {("gift", 1), ("gift", 2), ("comment", 1)}


def test_heartbeat_is_not_stretched_by_broken_clocks(envelope):
    days = ["2024-01-01T00:00:10Z", "2024-01-03T12:00:00Z", "1970-01-01T00:00:00Z", "0001-01-01T00:00:00Z", "9999-01-01T00:00:00Z"]
    env = envelope(*[event("gift", "{}", at=at) for at in days])
    beats = heartbeat(env).orderBy("window_start").collect()
    assert len(beats) == 2 * 288 + 145 and [beats[0].total_events, beats[-2].total_events, beats[-1].total_events] == [1, 1, 2]
    assert implausible(env).count() == 3
    assert heartbeat(env.limit(0)).count() == 0


def test_batch_and_stream_heartbeat_leave_out_the_same(spark, envelope, tmp_path):
    env = envelope(*[event("gift", "{}", at=at) for at in ("1999-12-31T23:59:59Z", "2000-01-01T00:00:00Z", "2024-01-01T00:00:00Z", "2100-01-01T00:00:00Z")])
    count_batch(env, 0, str(tmp_path / "h"))
    streamed = read_heartbeat(spark, str(tmp_path / "h"))
    assert sorted(r.window_start.year for r in streamed.collect()) == [2000, 2024] and streamed.agg({"events": "sum"}).first()[0] == 2
    near = env.where("received_at > '2020'")
    assert heartbeat(near).agg({"total_events": "max"}).first()[0] == 1


def test_heartbeat_scans_its_input_once(spark, envelope, tmp_path):
    path = str(tmp_path / "env")
    envelope(gift(10), gift(700)).write.parquet(path)
    jobs = spark.read.parquet(path)
    assert plan_of(heartbeat(jobs)).count("FileScan") == 0  # the windows have been written; nothing else is scanned
    assert heartbeat(jobs).count() == 3


def test_heartbeat_windows_need_not_divide_a_day(envelope):
    env = envelope(*[event("gift", "{}", at=f"2024-01-0{d}T05:00:00Z") for d in (1, 2, 3)])
    for every, seconds in (("7 minutes", 420), ("2 days", 172_800)):
        beats = [(b.window_start.timestamp(), b.total_events) for b in heartbeat(env, every).orderBy("window_start").collect()]
        assert {round(b - a) for (a, _), (b, _) in zip(beats, beats[1:])} <= {seconds}
        assert all(a % seconds == 0 for a, _ in beats) and beats[-1][1] == 3
