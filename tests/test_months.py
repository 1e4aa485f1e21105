"""Month-wise levelled tables, retention after compaction, and views kept up by the stream."""

import random
from datetime import datetime
from pathlib import Path

import pytest
from conftest import event
from pyspark.sql import functions as F

from roomtide.operators import gold
from roomtide.plans.retention import drop_expired, expired_months, retained, years_before
from roomtide.sinks import months
from roomtide.sinks.messages import to_messages
from roomtide.sources.kafka import file_lines
from roomtide.streaming import views
from roomtide.streaming.live import compact_live, read_live, route_batch, start_live

NOW = datetime(2024, 6, 10, 12)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def runs(root, table):
    return {m: sorted(str(f) for f in Path(root, f"{table}_runs").glob(f"run=*/{m}/*.parquet")) for m in month_names(root, table)}


def month_names(root, table):
    return {p.name for p in Path(root, f"{table}_runs").glob("run=*/yyyymm=*")}


def open_folders(root, table):
    return {p.name: sorted(int(b.name.removeprefix("batch_id=")) for b in p.glob("batch_id=*")) for p in Path(root, table).glob("yyyymm=*")}


def likes(envelope, number, *days):
    return to_messages(envelope(*[event("like", f'{{"batch_count":{number}}}', streamer=f"s{k % 3}", at=f"{d}T00:00:0{k % 10}Z") for k, d in enumerate(days)]))


def test_untouched_months_keep_their_files(spark, tmp_path, envelope):
    out = str(tmp_path)
    route_batch(likes(envelope, 0, "2024-01-05", "2024-02-05").select("value"), 0, out)
    assert compact_live(spark, out, "likes", upto=0) == ["yyyymm=202401", "yyyymm=202402"]
    before = runs(out, "likes")
    for number in range(1, 4):
        route_batch(likes(envelope, number, "2024-02-06", "2024-02-07").select("value"), number, out)
        assert compact_live(spark, out, "likes", upto=number) == ["yyyymm=202402"]
        assert runs(out, "likes")["yyyymm=202401"] == before["yyyymm=202401"] != []
    assert read_live(spark, out, "likes").count() == 8
    assert compact_live(spark, out, "likes", upto=3) == []
    # A batch goes once the manifest before the last one has it too.
    assert open_folders(out, "likes") == {"yyyymm=202401": [0], "yyyymm=202402": [3]}


def test_levels_bound_how_often_a_row_is_written(spark, tmp_path, envelope, monkeypatch):
    monkeypatch.setattr(months, "FANOUT", 3)
    out, folded = str(tmp_path), []
    real = months._rows_of
    monkeypatch.setattr(months, "_rows_of", lambda s, p, r, b, c: folded.append((len(r), b)) or real(s, p, r, b, c))
    for number in range(9):
        route_batch(likes(envelope, number, "2024-01-05").select("value"), number, out)
        compact_live(spark, out, "likes", upto=number)
    # Two runs of a level and the new batch make one of the next.
    assert [n for n, _ in folded] == [0, 0, 2, 0, 0, 2, 0, 0, 4]
    assert [r["level"] for r in months.manifests(spark, f"{out}/likes")["yyyymm=202401"]["runs"]] == [2]
    assert sorted(r.batch_count for r in read_live(spark, out, "likes").collect()) == list(range(9))


def test_a_reader_during_the_switch_sees_each_row_once(spark, tmp_path, envelope):
    out = str(tmp_path)
    for number in range(3):
        route_batch(likes(envelope, number, "2024-01-05", "2024-02-05").select("value"), number, out)
    compact_live(spark, out, "likes", upto=1)
    reader = read_live(spark, out, "likes")
    expected = sorted([0, 0, 1, 1, 2, 2])
    seen = []

    def watch(df):
        seen.append(sorted(r.batch_count for r in read_live(spark, out, "likes").collect()))
        return df

    months.fold_months(spark, f"{out}/likes", reader.schema, 2, watch)
    seen.append(sorted(r.batch_count for r in read_live(spark, out, "likes").collect()))
    # One that has taken its files before the fold still finds them.
    seen.append(sorted(r.batch_count for r in reader.collect()))
    assert seen == [expected] * 3


def test_a_fold_that_fails_leaves_the_table_as_it_was(spark, tmp_path, envelope, monkeypatch):
    out = str(tmp_path)
    for number in range(2):
        route_batch(likes(envelope, number, "2024-01-05", "2024-02-05").select("value"), number, out)
    compact_live(spark, out, "likes", upto=0)
    real, calls = months._publish, []

    def failing(spark_, path, month, manifest):
        calls.append(month)
        if len(calls) == 2:
            raise OSError("lost")
        real(spark_, path, month, manifest)

    monkeypatch.setattr(months, "_publish", failing)
    with pytest.raises(OSError):
        compact_live(spark, out, "likes", upto=1)
    monkeypatch.undo()
    assert sorted(r.batch_count for r in read_live(spark, out, "likes").collect()) == [0, 0, 1, 1]
    assert compact_live(spark, out, "likes", upto=1) == ["yyyymm=202402"]
    assert sorted(r.batch_count for r in read_live(spark, out, "likes").collect()) == [0, 0, 1, 1]


def test_only_finished_batches_are_folded(spark, tmp_path, envelope):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    likes(envelope, 1, "2024-01-05").select("value").write.text(source)
    start_live(file_lines(spark, source), out, checkpoint).awaitTermination()
    assert months.finished_batch(spark, checkpoint) == 0 and months.finished_batch(spark, str(tmp_path / "none")) == -1
    with pytest.raises(ValueError, match="not finished"):
        compact_live(spark, out, "likes", upto=1, checkpoint=checkpoint)
    assert compact_live(spark, out, "likes", upto=0, checkpoint=checkpoint) == ["yyyymm=202401"]


def test_no_expired_row_is_left_after_compaction(spark, tmp_path, envelope):
    """Months of two years back, one of them cut in the middle; folded and open batches."""
    out, days = str(tmp_path), ["2022-01-05", "2023-05-30", "2023-06-05", "2023-06-10", "2023-06-20", "2024-06-01"]
    for number in range(3):
        route_batch(likes(envelope, number, *days).select("value"), number, out)
    compact_live(spark, out, "likes", upto=1)
    cut = F.lit("2023-06-10 12:00:00").cast("timestamp")
    young = rows(read_live(spark, out, "likes").where(F.col("event_timestamp") >= cut))
    assert drop_expired(spark, out, "likes", NOW) == ["202201", "202305"]
    left = read_live(spark, out, "likes")
    assert {r.yyyymm for r in left.collect()} == {"202306", "202406"}
    assert left.where(F.col("event_timestamp") < cut).count() == 2  # of the open batch
    compact_live(spark, out, "likes", upto=2, expire_before=years_before(NOW, 1))
    assert drop_expired(spark, out, "likes", NOW) == []
    assert rows(read_live(spark, out, "likes")) == young == rows(retained(read_live(spark, out, "likes"), F.lit("2024-06-10 12:00:00").cast("timestamp")))
    # Dropped files go with the next change, and late rows of an expired month are seen until the next drop.
    assert not list(Path(out, "likes").glob("yyyymm=2022*/*")) and not list(Path(out, "likes_runs").glob("*/yyyymm=2022*"))
    route_batch(likes(envelope, 9, "2022-01-05").select("value"), 3, out)
    assert read_live(spark, out, "likes").where("yyyymm = '202201'").count() == 1
    assert drop_expired(spark, out, "likes", NOW) == ["202201"] and rows(read_live(spark, out, "likes")) == young


def test_years_before_a_leap_day():
    assert years_before(datetime(2024, 2, 29, 5), 1) == datetime(2023, 2, 28, 5)


def shop_events(rng, count):
    for k in range(count):
        at = f"202{rng.choice('34')}-0{rng.randrange(1, 7)}-{rng.randrange(1, 28):02}T00:00:00Z"
        who = {"streamer": rng.choice(["hot", "hot", "a", "b"]), "category": rng.choice(["npc", "ecommerce"]), "archetype": rng.choice(["x", "y"]), "at": at}
        if rng.random() < 0.6:
            user, gift = rng.choice(["", "u1", "u2", "u3"]), rng.choice(["rose", "lion", ""])
            flags = f'"streaking":{rng.choice(["true", "false"])},"repeat_end":{rng.choice(["true", "false"])}'
            yield event("gift", f'{{"unique_id":"{user}","gift_name":"{gift}","diamond_count":{rng.randrange(9)},"repeat_count":{rng.randrange(5)},{flags}}}', **who)
        else:
            yield event("product_pin", f'{{"product_id":"p{rng.randrange(4)}"}}', **who)


def recount(spark, out, name, category, since=None):
    view = views.VIEWS[name]
    table = read_live(spark, out, {"gift": "gifts", "product_pin": "product_pins"}[view.kind]).drop("yyyymm")
    if since is not None:
        table = table.where(F.col("event_timestamp") >= F.lit(since.isoformat(" ")).cast("timestamp"))
    report = {"npc_whale_analytics": gold.whale_analytics, "npc_streak_dynamics": gold.streak_dynamics, "ecommerce_vertical_performance": gold.vertical_performance}[name]
    return report(table, category)


def test_views_equal_the_recount_after_every_batch(spark, tmp_path, envelope):
    rng, out = random.Random(1), str(tmp_path)
    for number in range(5):
        batch = to_messages(envelope(*shop_events(rng, 60))).select("value")
        for _ in range(1 + number % 2):  # every other batch is replayed
            route_batch(batch, number, out, also=views.write_partials)
        if number in (1, 3):
            for name in views.VIEWS:
                views.compact_view(spark, out, name, upto=number - 1)
        for name, view in views.VIEWS.items():
            got = views.read_view(spark, out, name)
            assert rows(got) == rows(recount(spark, out, name, view.category)) != []
            assert got.columns == recount(spark, out, name, view.category).columns
    for name in views.VIEWS:
        for category, since in (("npc", None), ("ecommerce", datetime(2023, 4, 11))):
            assert rows(views.read_view(spark, out, name, category, since)) == rows(recount(spark, out, name, category, since))
        gone = views.drop_view_months(spark, out, name, lambda m: bool(expired_months([m], NOW)))
        assert gone and all(m < "202306" for m in gone)
    for table in ("gifts", "product_pins"):
        drop_expired(spark, out, table, NOW)
    for name, view in views.VIEWS.items():
        since = datetime(2023, 6, 10, 12)
        assert rows(views.read_view(spark, out, name, since=since)) == rows(recount(spark, out, name, view.category, since))


def test_a_view_is_read_from_partials_alone(spark, tmp_path, envelope):
    rng, out = random.Random(2), str(tmp_path)
    for number in range(2):
        route_batch(to_messages(envelope(*shop_events(rng, 400))).select("value"), number, out, also=views.write_partials)
    views.compact_view(spark, out, "npc_whale_analytics", upto=1)
    partials = views.read_partials(spark, out, "npc_whale_analytics")
    assert partials.count() < read_live(spark, out, "gifts").count() / 2
    files = views.read_view(spark, out, "npc_whale_analytics").inputFiles()
    assert files and all("/views/" in f for f in files)
