import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roomtide.operators.checks import check_events, classify_checks, live_summary, probe_events
from roomtide.operators.registry import actionable, as_registry_events, fold_registry, list_candidates

START = datetime(2024, 1, 1)
LOG = (
    "seq bigint, ts timestamp, handle string, op string, category string, archetype string, source string, "
    "passed boolean, viewers bigint, diamonds bigint, delay_sec bigint, reason string"
)


def random_log(n, seed, creators=40):
    rng = random.Random(seed)
    log = []
    for seq in range(n):
        handle = rng.choice([f"h{rng.randrange(creators)}", "hot"])
        op = rng.choice(["add", "offline", "probation", "stream_end", "invalid", "offline", "probation"])
        if op == "add" and rng.random() < 0.3:
            handle = f" @{handle.upper()}"
        log.append((
            seq, START + timedelta(seconds=17 * seq), handle, op, rng.choice(["npc", "ecommerce"]),
            rng.choice(["general", "beauty", "tech"]), f"src{seq % 5}", rng.random() < 0.5, rng.randrange(90),
            rng.randrange(1000), rng.choice([180, 300]), f"why{seq % 3}",
        ))
    return log


def sequential(log, cooldown):
    """One event after the other, as plainly as can be."""
    pool = {}
    for seq, ts, handle, op, category, archetype, source, passed, viewers, diamonds, delay, reason in log:
        name = handle.strip().lstrip("@").lower() if op == "add" else handle.lower()
        if op == "add":
            if name not in pool:
                pool[name] = dict(
                    category=category, archetype=archetype, source=source, discovered_at=ts, status="candidate",
                    cooldown_until=None, blacklist_reason=None, total_sessions=0, peak_viewers=0,
                    total_diamonds_seen=0, last_live=None, last_checked=None, first_seq=seq,
                )
            elif pool[name]["archetype"] == "general":
                pool[name]["archetype"] = archetype
            continue
        if name not in pool:
            continue
        row = pool[name]

        def cool(until):
            if cooldown == "max" and row["cooldown_until"] is not None:
                until = max(until, row["cooldown_until"])
            row["cooldown_until"] = until

        if op == "offline":
            cool(ts + timedelta(seconds=delay))
            row["last_checked"] = ts
        elif op == "stream_end":
            cool(ts + timedelta(minutes=15))
        elif op == "invalid":
            row["status"], row["blacklist_reason"] = "blacklisted", reason
        else:
            row["total_sessions"] += 1
            row["peak_viewers"] = max(row["peak_viewers"], viewers)
            row["total_diamonds_seen"] += diamonds
            row["last_live"] = ts
            row["status"] = "qualified" if passed else "cooldown"
            if passed:
                row["cooldown_until"] = None
            else:
                cool(ts + timedelta(hours=3))
    return pool


def as_dicts(registry):
    times = ("discovered_at", "cooldown_until", "last_live", "last_checked")
    naive = registry.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})
    return {r.username: {k: v for k, v in r.asDict().items() if k != "username"} for r in naive.collect()}


def frame(spark, log):
    naive = LOG.replace("ts timestamp", "ts timestamp_ntz")
    return spark.createDataFrame(log, naive).withColumn("ts", F.col("ts").cast("timestamp")).repartition(6)


@pytest.mark.parametrize("cooldown", ["last", "max"])
@pytest.mark.parametrize("seed", [1, 2])
def test_fold_equals_the_sequential_run(spark, cooldown, seed):
    log = random_log(1500, seed)
    assert as_dicts(fold_registry(frame(spark, log), cooldown=cooldown)) == sequential(log, cooldown)


@pytest.mark.parametrize("cooldown", ["last", "max"])
def test_fold_in_steps_equals_the_fold(spark, cooldown):
    log = random_log(900, 3)
    state = None
    for part in (log[:100], log[100:101], log[101:600], log[600:]):
        state = fold_registry(frame(spark, part), state, cooldown).checkpoint()
    assert as_dicts(state) == sequential(log, cooldown)


def test_stream_end_cuts_the_long_cooldown_unless_max(spark):
    log = [
        (1, START, "a", "add", "npc", "general", "x", None, None, None, None, None),
        (2, START, "a", "probation", None, None, None, False, 1, 0, None, None),
        (3, START, "a", "stream_end", None, None, None, None, None, None, None, None),
    ]
    until = {c: as_dicts(fold_registry(frame(spark, log), cooldown=c))["a"]["cooldown_until"] for c in ("last", "max")}
    assert until == {"last": START + timedelta(minutes=15), "max": START + timedelta(hours=3)}


def test_next_to_check(spark):
    now = START + timedelta(hours=1)
    registry = spark.createDataFrame(
        [
            ("late", "npc", "g", "candidate", None, 9), ("early", "npc", "g", "candidate", None, 1),
            ("cool", "npc", "g", "candidate", "2024-01-01 02:00:00", 2), ("over", "npc", "g", "qualified", "2024-01-01 01:00:00", 8),
            ("odd", "npc", "g", "cooldown", "whenever", 3), ("bad", "npc", "g", "blacklisted", None, 0),
            ("busy", "npc", "g", "qualified", None, 0),
        ],
        "username string, category string, archetype string, status string, cooldown_until string, first_seq bigint",
    )
    active = spark.createDataFrame([("BUSY",)], "username string")
    queue = actionable(registry, active, F.lit(now).cast("timestamp"))
    assert [(r.username, r.priority) for r in queue.collect()] == [("over", 1), ("early", 2), ("late", 2), ("odd", 3)]
    assert [r.username for r in actionable(registry, active, F.lit(now), limit=1).collect()] == ["over"]


def test_listing_order(spark):
    registry = spark.createDataFrame(
        [("a", "npc", "candidate", 2), ("b", "npc", "qualified", 4), ("c", "ecommerce", "cooldown", 3), ("d", "npc", "cooldown", 1)],
        "username string, category string, status string, first_seq bigint",
    ).withColumns({"archetype": F.lit("g"), "peak_viewers": F.lit(0)})
    assert [r.username for r in list_candidates(registry).collect()] == ["b", "c", "d", "a"]


def test_checks(spark):
    checks = spark.createDataFrame(
        [("a", True, None), ("b", False, None), ("c", None, "Not Capable of Going LIVE"), ("d", None, "timeout"),
         ("e", None, "it DOES NOT EXIST"), ("f", None, "user_not_found")],
        "username string, is_live boolean, error string",
    )
    found = {r.username: (r.outcome, r.op, r.delay_sec, r.reason) for r in classify_checks(checks).collect()}
    fatal = ("blacklist", "invalid", None, "incapable_of_live")
    assert found == {
        "a": ("live", None, None, None), "b": ("offline", "offline", 180, None), "c": fatal,
        "d": ("error", "offline", 300, None), "e": fatal, "f": fatal,
    }
    log = as_registry_events(check_events(checks))
    assert {r.handle for r in log.collect()} == set("bcdef")
    assert {r.handle for r in probe_events(checks).collect()} == set("cef")
    pool = spark.createDataFrame([("a", "candidate"), ("b", "blacklisted"), ("z", "cooldown"), ("q", None)], "username string, status string")
    probes = spark.createDataFrame(
        [(1, "a", False, None), (2, "A", True, None), (1, "b", True, None), (1, "stranger", True, None),
         (1, "z", True, None), (2, "z", True, "timeout"), (1, "q", None, None)],
        "seq long, username string, is_live boolean, error string",
    )
    assert live_summary(pool, probes).first().asDict() == {"live_now": 1, "total_candidates": 4}
    assert live_summary(pool, probes.limit(0)).first().asDict() == {"live_now": 0, "total_candidates": 4}


def test_an_invalid_event_without_reason_has_the_usual_one(spark):
    log = [
        (1, START, "a", "add", "npc", "general", "x", None, None, None, None, None),
        (2, START, "a", "invalid", None, None, None, None, None, None, None, None),
    ]
    assert as_dicts(fold_registry(frame(spark, log)))["a"]["blacklist_reason"] == "invalid_user"
