import json
import os

import pytest
from conftest import SF_DIR, event, plan_of
from pyspark.sql import functions as F

from contract import inputs
from contract.inputs import bronze, spark_input, zoned
from roomtide.operators import gold
from roomtide.operators.registry import as_registry_events, fold_registry
from roomtide.operators.silver import typed
from roomtide.operators.telemetry import timed_events, window_counts
from roomtide.schemas import ENVELOPE, REGISTRY_EVENTS, TABLES
from roomtide.sinks.messages import to_messages
from roomtide.sources.archive import read_all_days
from roomtide.sources.envelopes import good, parse_envelopes, quarantined
from roomtide.sources.kafka import file_lines
from roomtide.streaming import repairs
from roomtide.streaming.heartbeat import count_batch, read_heartbeat, start_heartbeat
from roomtide.streaming.live import compact_live, read_live, read_quarantine, route_batch, start_archive, start_live
from roomtide.streaming.registry import advance, read_latest, read_version, start_registry


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines"))
    spark_input(spark, SF_DIR, inputs.LINES).select("value").repartition(4).write.mode("overwrite").text(path)
    return path


def test_stream_gives_the_batch_tables(spark, lines, tmp_path):
    out = str(tmp_path / "out")
    start_live(file_lines(spark, lines, max_files=1), out, str(tmp_path / "c")).awaitTermination()
    parsed = parse_envelopes(spark.read.text(lines))
    for kind, table in TABLES.items():
        assert rows(read_live(spark, out, table).drop("yyyymm")) == rows(typed(good(parsed), kind, "live"))
    assert rows(read_quarantine(spark, out).drop("batch_id")) == rows(quarantined(parsed))
    live = gold.whale_analytics(read_live(spark, out, "gifts"))
    assert rows(live) == rows(gold.whale_analytics(typed(good(parsed), "gift", "live")))


def test_restart_goes_on_where_it_stopped(spark, tmp_path, envelope):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    for expected in (1, 2):
        to_messages(envelope(event("like", "{}"))).select("value").write.mode("append").text(source)
        start_live(file_lines(spark, source), out, checkpoint).awaitTermination()
        assert read_live(spark, out, "likes").count() == expected


def test_replayed_batch_changes_nothing(spark, lines, tmp_path):
    out = str(tmp_path / "out")
    batch = spark.read.text(lines)
    route_batch(batch, 0, out)
    once = {t: rows(read_live(spark, out, t)) for t in TABLES.values()}, rows(read_quarantine(spark, out))
    route_batch(batch, 0, out)
    assert once == ({t: rows(read_live(spark, out, t)) for t in TABLES.values()}, rows(read_quarantine(spark, out)))
    route_batch(batch, 1, out)
    assert read_live(spark, out, "gifts").count() == 2 * len(once[0]["gifts"])


def test_too_many_bad_messages_stop_the_batch(spark, lines, tmp_path):
    with pytest.raises(ValueError, match="bad messages"):
        route_batch(spark.read.text(lines), 0, str(tmp_path / "out"), max_bad_per_batch=3)


def test_live_files_are_sorted_within_month_folders(spark, lines, tmp_path):
    out = str(tmp_path / "out")
    route_batch(spark.read.text(lines).coalesce(1), 0, out)
    assert os.listdir(f"{out}/likes/yyyymm=202401") == ["batch_id=0"]
    found = [tuple(r) for r in read_live(spark, out, "likes").select("category", "archetype", "streamer", "event_timestamp").collect()]
    assert found == sorted(found)


def test_repeated_messages_can_be_dropped(spark, tmp_path, envelope):
    source = str(tmp_path / "in")
    to_messages(envelope(*[event("like", "{}")] * 3, event("like", '{"batch_count":2}'))).select("value").write.text(source)
    for name, dedup, count in (("all", None, 4), ("once", "10 minutes", 2)):
        out = str(tmp_path / name)
        start_live(file_lines(spark, source), out, f"{out}-c", optional_dedup=dedup).awaitTermination()
        assert read_live(spark, out, "likes").count() == count


def test_archive_stream(spark, tmp_path, envelope):
    source, root = str(tmp_path / "in"), str(tmp_path / "archive")
    messages = to_messages(envelope(event("like", "{}"), event("gift", "{}", category="ecommerce")))
    messages.write.parquet(source)
    stream = spark.readStream.schema(messages.schema).parquet(source)
    start_archive(stream, root, str(tmp_path / "c"), every=None).awaitTermination()
    assert rows(read_all_days(spark, root).select("topic", "value")) == rows(messages)


def test_heartbeat_stream_counts_every_event(spark, tmp_path):
    env = bronze(spark, SF_DIR)
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    # Two batches in the wrong order: the second one is older than all of the first.
    late = env.where("received_at < '2024-01-10'")
    for part in (env.exceptAll(late), late):
        part.coalesce(1).write.mode("append").parquet(source)
        start_heartbeat(spark.readStream.schema(ENVELOPE).parquet(source), root, str(tmp_path / "c")).awaitTermination()
    expected = window_counts(timed_events(env)).select(F.col("window.start").alias("window_start"), "events", *TABLES)
    assert rows(read_heartbeat(spark, root)) == rows(expected) != []


def test_replayed_heartbeat_batch_changes_nothing(spark, tmp_path, envelope):
    root = str(tmp_path / "out")
    for batch in (0, 0, 1):
        count_batch(envelope(event("like", "{}")), batch, root)
    assert [r.events for r in read_heartbeat(spark, root).collect()] == [2]


def test_late_messages_are_no_duplicates(spark, tmp_path, envelope):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for at in ("2024-01-05T00:00:00Z", "2024-01-01T00:00:00Z", "2024-01-05T00:00:00Z", "soon"):
        to_messages(envelope(event("like", "{}", at=at))).select("value").coalesce(1).write.mode("append").text(source)
        start_live(file_lines(spark, source), out, f"{out}-c", optional_dedup="10 minutes").awaitTermination()
    assert read_live(spark, out, "likes").count() == 2 and read_quarantine(spark, out).count() == 1


@pytest.mark.parametrize("cooldown", ["last", "max"])
def test_registry_stream_equals_the_fold(spark, tmp_path, cooldown):
    log = as_registry_events(zoned(spark_input(spark, SF_DIR, inputs.REGISTRY_LOG), "ts")).cache()
    root = str(tmp_path / "registry")
    cuts = [0, 300, 301, 700, 10_000_000]
    for batch, (low, high) in enumerate(zip(cuts, cuts[1:])):
        advance(log.where((F.col("seq") >= low) & (F.col("seq") < high)), batch, root, cooldown)
        advance(log.where((F.col("seq") >= low) & (F.col("seq") < high)), batch, root, cooldown)
    assert rows(read_version(spark, root, 3)) == rows(fold_registry(log, cooldown=cooldown))


def test_old_registry_versions_go(spark, tmp_path):
    log = as_registry_events(zoned(spark_input(spark, SF_DIR, inputs.REGISTRY_LOG), "ts"))
    root = str(tmp_path / "registry")
    for batch in range(4):
        advance(log.where(F.col("seq") % 4 == batch), batch, root, keep=2, buckets=4)
    assert sorted(n for n in os.listdir(f"{root}/_manifests") if n.isdigit()) == ["2", "3"]
    used = {(b, n) for v in (2, 3) for b, n in json.loads((tmp_path / "registry" / "_manifests" / str(v)).read_text())["written"].items()}
    assert {(p.name.removeprefix("bucket="), int(p.parent.name.removeprefix("batch="))) for p in tmp_path.glob("registry/batch=*/bucket=*")} == used
    with pytest.raises(ValueError):
        advance(log, 4, root, keep=1)


def test_a_batch_of_one_creator_writes_one_bucket(spark, tmp_path):
    log = as_registry_events(zoned(spark_input(spark, SF_DIR, inputs.REGISTRY_LOG), "ts")).cache()
    root = tmp_path / "registry"
    assert len(advance(log, 0, str(root), buckets=16)) > 8
    before = {p: p.stat().st_mtime_ns for p in root.rglob("*.parquet")}
    one = log.groupBy("handle").count().orderBy(F.desc("count")).first().handle
    more = log.where(F.col("handle") == one).withColumn("seq", F.col("seq") + 10**9)
    assert len(advance(more, 1, str(root), buckets=99)) == 1
    assert len(list(root.glob("batch=1/bucket=*"))) == 1
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    assert rows(read_latest(spark, str(root))) == rows(fold_registry(more, fold_registry(log)))
    # Unknown creators change nothing, and a batch without events has a version too.
    unknown = log.limit(1).withColumns({"handle": F.lit("nobody"), "op": F.lit("offline")})
    for batch, events in ((2, unknown), (3, unknown.limit(0))):
        advance(events, batch, str(root))
        assert rows(read_version(spark, str(root), batch)) == rows(read_version(spark, str(root), 1))


def test_registry_query(spark, tmp_path):
    log = as_registry_events(zoned(spark_input(spark, SF_DIR, inputs.REGISTRY_LOG), "ts"))
    source = str(tmp_path / "in")
    log.write.parquet(source)
    stream = spark.readStream.schema(REGISTRY_EVENTS).parquet(source)
    start_registry(stream, str(tmp_path / "r"), str(tmp_path / "c")).awaitTermination()
    assert rows(read_version(spark, str(tmp_path / "r"), 0)) == rows(fold_registry(log))


def test_compaction_loses_and_doubles_nothing(spark, tmp_path, envelope):
    out = str(tmp_path / "out")
    batches = [
        to_messages(envelope(*[event("like", f'{{"batch_count":{b}}}', streamer=f"s{k}", at=f"2024-0{1 + k % 2}-01T00:00:00Z") for k in range(4)]))
        for b in range(9)
    ]
    for b, messages in enumerate(batches):
        route_batch(messages.select("value"), b, out)
        if b % 3 == 2:
            before = rows(read_live(spark, out, "likes"))
            compact_live(spark, out, "likes", upto=b - 1)
            assert rows(read_live(spark, out, "likes")) == before and len(before) == 4 * (b + 1)
    # A replay of a folded batch is not seen twice, and compacting again changes nothing.
    route_batch(batches[7].select("value"), 7, out)
    compact_live(spark, out, "likes", upto=7)
    assert read_live(spark, out, "likes").count() == 36
    left = {p.name: sorted(b.name for b in p.glob("batch_id=*")) for p in (tmp_path / "out" / "likes").iterdir() if p.is_dir()}
    assert left == {m: ["batch_id=5", "batch_id=6", "batch_id=7", "batch_id=8"] for m in ("yyyymm=202401", "yyyymm=202402")}


def test_corrected_lines_are_replayed_once(spark, tmp_path, envelope, monkeypatch):
    out = str(tmp_path / "out")
    good_line = to_messages(envelope(event("like", "{}"))).first().value
    bad = ['{"broken"', good_line.replace("2024-01-01", "someday"), good_line.replace("2024-01-01", "never")]
    table = lambda *rows_: spark.createDataFrame(list(rows_), "raw string, value string")
    for number in range(2):
        lines = spark.createDataFrame([(v,) for v in [good_line, *bad, bad[1]]], "value string")
        route_batch(lines, number, out)
    assert read_live(spark, out, "likes").count() == 2 and repairs.waiting(spark, out).count() == 8
    fixes = table((bad[1], good_line), (bad[1], good_line), (bad[1], "still {"), (bad[2], "no json"), ("unknown", good_line))
    real = repairs.route_batch

    def failing(*args):
        real(*args)
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(repairs, "route_batch", failing)
        with pytest.raises(OSError):
            repairs.repair_quarantine(spark, out, fixes)
    assert repairs.read_with_repairs(spark, out, "likes").count() == 2  # nothing of the failed one is seen
    assert [repairs.repair_quarantine(spark, out, fixes) for _ in range(2)] == [4, 0]
    assert repairs.read_with_repairs(spark, out, "likes").count() == 6 and repairs.waiting(spark, out).count() == 4
    assert repairs.repair_quarantine(spark, out, table((bad[0], good_line))) == 2
    assert repairs.read_with_repairs(spark, out, "likes").count() == 8
    assert {r.raw for r in repairs.waiting(spark, out).collect()} == {bad[2]}


def test_repairs_send_no_lines_through_the_driver(spark, tmp_path, envelope, monkeypatch):
    out, plans = str(tmp_path / "out"), []
    good_line = to_messages(envelope(event("like", "{}"))).first().value
    bad = good_line.replace("2024-01-01", "someday")
    route_batch(spark.createDataFrame([(bad,), (good_line,)], "value string"), 0, out)
    real = repairs.route_batch

    def seen(lines, *more):
        plans.append(plan_of(lines))
        real(lines, *more)

    monkeypatch.setattr(repairs, "route_batch", seen)
    fixes = spark.createDataFrame([(bad, good_line)], "raw string, value string")
    assert [repairs.repair_quarantine(spark, out, fixes) for _ in range(2)] == [1, 0]
    plans.append(plan_of(repairs.waiting(spark, out)))
    assert all("SortMergeJoin" in plan and "Broadcast" not in plan for plan in plans)


def test_the_latest_complete_version_is_read(spark, tmp_path):
    log = as_registry_events(zoned(spark_input(spark, SF_DIR, inputs.REGISTRY_LOG), "ts"))
    root = str(tmp_path / "registry")
    assert read_latest(spark, root) is None
    for batch in range(3):
        advance(log.where(F.col("seq") % 3 == batch), batch, root)
    os.remove(f"{root}/_manifests/2")
    assert rows(read_latest(spark, root)) == rows(read_version(spark, root, 1))
