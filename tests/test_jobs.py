from datetime import datetime
from pathlib import Path

import pytest
from conftest import SF_DIR, event, plan_of
from pyspark.sql import functions as F

from contract import spark_queries
from contract.inputs import bronze
from roomtide.operators.silver import typed
from roomtide.plans.local import local_tables, run_local
from roomtide.plans.nightly import published, read_nightly, read_undated_quarantine, run_nightly, run_undated
from roomtide.plans.retention import drop_expired, expired_months, retained
from roomtide.sinks.archive import write_archive
from roomtide.sinks.messages import append_jsonl, to_messages
from roomtide.sinks.tables import materialise, write_day, write_live
from roomtide.sources.archive import read_all_days
from roomtide.streaming.live import read_live

DAY = "2024-01-05"


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """An archive of two days with one damaged line."""
    root = str(tmp_path_factory.mktemp("lake"))
    env = bronze(spark, SF_DIR).where("received_at >= '2024-01-05' and received_at < '2024-01-07'")
    messages = to_messages(env)
    undated = messages.limit(1).withColumn("value", F.lit('{"received_at":"2024-01-05T01:00:00+00:00","event_type":5'))
    write_archive(messages.unionByName(undated), root, batch_id=0)
    return root, env.cache()


def test_archive_is_text_as_received(spark, lake):
    root, env = lake
    stored = read_all_days(spark, root).where("value like '%}}'").select("topic", "value")
    assert rows(stored) == rows(to_messages(env))
    hours = {p.name for p in Path(root).glob("topic=*/year=2024/month=01/day=*/hour=*")}
    assert all(len(h) == len("hour=00") for h in hours)


def test_replayed_archive_batch_replaces_itself(spark, tmp_path, envelope):
    root = str(tmp_path / "a")
    messages = to_messages(envelope(event("like", "{}"), event("gift", "{}")))
    for batch in (0, 1, 1):
        write_archive(messages, root, batch)
    assert read_all_days(spark, root).count() == 4


def test_archive_keeps_undated_messages(spark, tmp_path, envelope):
    root = str(tmp_path / "a")
    write_archive(to_messages(envelope(event("like", "{}", at="soon"))), root, 0)
    assert read_all_days(spark, root).count() == 1


def test_folder_filters_prune(spark, lake):
    plan = plan_of(read_all_days(spark, lake[0]).where("year = '2024' and month = '01' and day = '05'"))
    assert "PartitionFilters: [isnotnull(year" in plan and "(day" in plan


def test_nightly_run(spark, lake, tmp_path):
    root, env = lake
    out = str(tmp_path / "out")
    summary = {r.item: r for r in run_nightly(spark, root, DAY, out_root=out).collect()}
    day = env.where(f"received_at like '{DAY}%'")
    assert summary["total"].rows == day.count()
    assert summary["quarantine"].rows == 1
    for table, kind in (("gifts", "gift"), ("likes", "like"), ("room_viewers", "room_users")):
        written = read_nightly(spark, out, table).drop("year", "month", "day")
        assert rows(written) == rows(typed(day, kind))
        assert summary[table].rows == written.count()


def test_nightly_run_twice_gives_the_same(spark, lake, tmp_path):
    root, _ = lake
    out = str(tmp_path / "out")
    run_nightly(spark, root, DAY, out_root=out)
    first = rows(read_nightly(spark, out, "gifts"))
    run_nightly(spark, root, DAY, out_root=out)
    assert rows(read_nightly(spark, out, "gifts")) == first
    run_nightly(spark, root, "2024-01-06", out_root=out)
    both = read_nightly(spark, out, "gifts")
    assert rows(both.where("day = '05'")) == first and both.where("day = '06'").count() > 0


def test_dry_run_writes_nothing(spark, lake, tmp_path):
    out = tmp_path / "out"
    rows_of = {r.item: r.rows for r in run_nightly(spark, lake[0], DAY, dry_run=True, out_root=str(out)).collect()}
    total = rows_of.pop("total")
    assert total == sum(rows_of.values()) and {"gift", "battle"} <= set(rows_of) and not out.exists()


def test_day_without_data(spark, lake):
    assert run_nightly(spark, lake[0], "2020-01-01").count() == 0


def test_empty_tables_are_skipped(spark, tmp_path, envelope):
    root = str(tmp_path / "lake")
    write_archive(to_messages(envelope(event("like", "{}"))), root, 0)
    summary = {r.item: r.path for r in run_nightly(spark, root, "2024-01-01").collect()}
    assert summary["likes"] and summary["gifts"] is None
    assert not Path(root, "silver", "gifts").exists()


def test_other_topic_folders_can_be_read(spark, tmp_path):
    folder = tmp_path / "events.npc" / "year=2024" / "month=01" / "day=01" / "hour=00"
    folder.mkdir(parents=True)
    (folder / "x.json").write_text('{"streamer":"s","category":"npc","event_type":"like","received_at":"2024-01-01T00:00:00Z","data":{"batch_count":4}}\n')
    run_nightly(spark, str(tmp_path), "2024-01-01", topics="events.*")
    assert read_nightly(spark, str(tmp_path), "likes").first().batch_count == 4


def test_day_layout_and_codec(spark, tmp_path, envelope):
    path = tmp_path / "likes"
    write_day(typed(envelope(*[event("like", "{}", streamer=s) for s in "aab"]), "like"), str(path))
    files = list(path.glob("category=npc/streamer=*/*.parquet"))
    assert {f.parent.name for f in files} == {"streamer=a", "streamer=b"}
    assert all(".zstd." in f.name for f in files)


def test_a_hot_streamer_is_split_and_small_ones_share(spark, tmp_path):
    likes = spark.range(300_000, numPartitions=6).select(
        F.lit("npc").alias("category"), F.xxhash64("id").alias("value"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 20)).alias("streamer"),
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        write_day(likes, str(tmp_path / "likes"))
    finally:
        for key in settings:
            spark.conf.unset(key)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "likes" / "category=npc").iterdir() if d.is_dir()}
    # Small streamers that hash to the hot one's partition are split along with it; the others are not.
    assert files.pop("streamer=hot") > 3 and sum(n == 1 for n in files.values()) > len(files) / 2
    assert spark.read.parquet(str(tmp_path / "likes")).count() == 300_000


def test_local_run(spark, tmp_path):
    env = bronze(spark, SF_DIR)
    append_jsonl(env, str(tmp_path / "in"))
    lazy = run_local(spark, str(tmp_path / "in"))
    stored = run_local(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert set(lazy) == set(stored) and lazy["quarantine"].count() == 0
    for name, df in local_tables(env).items():
        assert rows(stored[f"silver_{name}"]) == rows(df) == rows(lazy[f"silver_{name}"])
        assert (tmp_path / "out" / f"silver_{name}").exists()
    for name in ("event_overview", "viewer_metrics", "top_likers", "gift_revenue", "top_commenters"):
        assert rows(stored[name]) == rows(lazy[name]) != []


def test_replaceable_tables(spark, envelope):
    for n in (2, 1):
        materialise({"likes": typed(envelope(*[event("like", "{}")] * n), "like")}, prefix="t_")
    assert spark.table("t_likes").count() == 1
    spark.sql("drop table t_likes")


def test_retention(spark, tmp_path, envelope):
    env = envelope(*[event("like", "{}", at=f"{m}-15T00:00:00+00:00") for m in ("2023-01", "2023-02", "2024-01")])
    root = str(tmp_path / "live")
    write_live(typed(env, "like", "live"), "likes", root, 0)
    table = spark.read.schema("event_timestamp timestamp, yyyymm string").parquet(f"{root}/likes")
    kept = retained(table, F.lit(datetime(2024, 2, 10)).cast("timestamp"))
    assert kept.count() == 2
    assert "PartitionFilters: [isnotnull(yyyymm" in plan_of(kept)
    assert drop_expired(spark, root, "likes", datetime(2024, 2, 10)) == ["202301"]
    assert sorted(r.yyyymm for r in read_live(spark, root, "likes").collect()) == ["202302", "202401"]
    assert drop_expired(spark, root, "likes", datetime(2024, 2, 10)) == []
    assert drop_expired(spark, str(tmp_path / "none"), "likes", datetime(2024, 2, 10)) == []


def test_a_month_expires_as_a_whole():
    assert expired_months(["202301", "202302"], datetime(2024, 2, 28)) == ["202301"]
    assert expired_months(["202301", "202302"], datetime(2024, 3, 1)) == ["202301", "202302"]


def test_a_rerun_replaces_the_whole_day(spark, tmp_path, envelope):
    out = str(tmp_path / "out")
    like, gift = event("like", "{}"), event("gift", "{}")
    for lake, rows_, bad in (("a", [like, gift], True), ("b", [like], False)):
        messages = to_messages(envelope(*rows_))
        if bad:
            messages = messages.unionByName(messages.limit(1).withColumn("value", F.lit('{"received_at":"2024-01-01T01:00:00Z","x":')))
        write_archive(messages, str(tmp_path / lake), 0)
        run_nightly(spark, str(tmp_path / lake), "2024-01-01", out_root=out)
    folders = {p.name for p in Path(out, "silver").glob("*") if list(p.glob("year=*/month=*/day=*"))}
    assert folders == {"likes"}
    run_nightly(spark, str(tmp_path / "none"), "2024-01-01", out_root=out)
    assert not list(Path(out, "silver").glob("*/year=*/month=*/day=*"))


def test_a_rerun_that_fails_leaves_the_day_whole(spark, lake, tmp_path, monkeypatch):
    root, env = lake
    out = str(tmp_path / "out")
    run_nightly(spark, root, DAY, out_root=out)
    tables = [t for t in ("gifts", "likes", "comments", "room_viewers", "product_pins")]
    before = {t: rows(read_nightly(spark, out, t)) for t in tables}
    written = []

    def failing(df, path):
        if len(written) == 2:
            raise OSError("lost")
        written.append(path)
        write_day(df.limit(1), path)

    with monkeypatch.context() as broken:
        broken.setattr("roomtide.plans.nightly.write_day", failing)
        with pytest.raises(OSError):
            run_nightly(spark, root, DAY, out_root=out)
    assert len(written) == 2 and {t: rows(read_nightly(spark, out, t)) for t in tables} == before
    run_nightly(spark, root, DAY, out_root=out)
    assert {t: rows(read_nightly(spark, out, t)) for t in tables} == before
    runs = {p.name for p in Path(out, "silver").glob("*/year=*/month=*/day=*/run=*")}
    assert runs == {f"run={published(spark, out, DAY)['run']}"}
    assert rows(read_nightly(spark, out, "gifts", days=[DAY])) == before["gifts"]
    assert read_nightly(spark, out, "gifts", days=["2024-01-06"]).count() == 0


def test_messages_with_line_breaks_come_back(spark, tmp_path):
    pretty = '{\n "streamer": "s",\r\n "category": "npc", "event_type": "like",\n "received_at": "2024-01-01T00:00:00Z", "data": {"batch_count":\n 4}}'
    odd = ['"quoted"', 'broken\n{"a":', '"open\r', '{"received_at":"2024-01-01T00:00:00Z"', "plain \\n text"]
    values = spark.createDataFrame([("t", v) for v in (pretty, *odd)], "topic string, value string")
    root = str(tmp_path / "a")
    write_archive(values, root, 0)
    got = {r.value for r in read_all_days(spark, root).collect()}
    assert got == {pretty.replace("\n", " ").replace("\r", " "), *odd}
    run_nightly(spark, root, "2024-01-01", topics="topic=t")
    assert read_nightly(spark, root, "likes").first().batch_count == 4
    assert run_undated(spark, root) == 4
    assert {r.raw for r in read_undated_quarantine(spark, root).collect()} == {o for o in odd if "received_at" not in o}


def test_payloads_with_line_breaks_stay_one_message(spark, tmp_path, envelope):
    append_jsonl(envelope(event("like", '{"batch_count":\n 3}')), str(tmp_path / "in"))
    assert run_local(spark, str(tmp_path / "in"))["silver_likes"].first().batch_count == 3


def test_the_registered_jobs_archive_every_message_and_run_every_day(spark, monkeypatch):
    archived, ran = [], []
    monkeypatch.setattr(spark_queries, "write_archive", lambda messages, root, **more: archived.append(messages))
    monkeypatch.setattr(spark_queries, "run_nightly", lambda s, lake, day, **more: ran.append(day) or s.range(0).selectExpr("'' as date", "'' as item", "0 as rows"))
    everything = rows(to_messages(bronze(spark, SF_DIR)))
    spark_queries.nightly_of(spark, SF_DIR)
    assert ran == [f"2024-01-{k:02}" for k in range(1, 31)] + [DAY.replace("05", "06")]
    spark_queries.nightly_dry_run(spark, SF_DIR)
    assert rows(archived[0]) == rows(archived[2]) == everything
    assert len(archived) == 3 and 0 < archived[1].count() < len(everything)
