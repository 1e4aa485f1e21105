"""name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import functools
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contract import inputs
from contract.inputs import battles, bronze, spark_input, zoned
from roomtide.functions.casts import event_time, to_bigint, to_flag
from roomtide.functions.identity import (
    comment_text,
    normalize_handle,
    shown_pins,
    with_gift_defaults,
    with_like_defaults,
    with_room_defaults,
    with_user_identity,
)
from roomtide.operators import checks, gate, gold, registry, sessions, spider, telemetry
from roomtide.operators.silver import typed
from roomtide.plans.local import run_local
from roomtide.plans.nightly import read_nightly, read_undated_quarantine, run_nightly, run_undated
from roomtide.plans.retention import drop_expired, retained, years_before
from roomtide.runtime import cut_lineage, shared_folder
from roomtide.schemas import ENVELOPE, LOCAL_KINDS, REGISTRY_EVENTS, TABLES
from roomtide.sinks.archive import write_archive
from roomtide.sinks.messages import append_jsonl, to_messages
from roomtide.sinks.registry_files import write_snapshot
from roomtide.sinks.tables import materialise
from roomtide.sources.archive import archive_columns, read_all_days
from roomtide.sources.config_files import config_adds, read_config
from roomtide.sources.envelopes import good, parse_envelopes, quarantined
from roomtide.sources.kafka import file_lines
from roomtide.sources.registry_files import read_snapshot
from roomtide.streaming import gate as stream_gate
from roomtide.streaming import repairs, states, views
from roomtide.streaming.heartbeat import read_heartbeat, start_heartbeat
from roomtide.streaming.live import compact_live, read_live, read_quarantine, start_archive, start_live
from roomtide.streaming.registry import read_latest, start_registry

# The gate runs on days instead of minutes, because the events are sparse.
GATE_SECONDS = 6 * 3600
NOW = "timestamp '2024-01-28 00:00:00'"
RETENTION_NOW = "timestamp '2025-01-16 12:00:00'"
KIND_OF = {table: kind for kind, table in TABLES.items()}


def naive(df: DataFrame) -> DataFrame:
    """Instants as zoneless UTC, the form the comparison uses."""
    zoned_columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned_columns})


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def silver(spark, sf_dir, table, mode="batch"):
    return typed(bronze(spark, sf_dir), KIND_OF[table], mode)


def gift_facts(spark, sf_dir):
    return spark_input(spark, sf_dir, inputs.GIFT_FACTS)


def daily_sessions(envelope: DataFrame) -> DataFrame:
    timed = envelope.select("streamer", "category", event_time(F.col("received_at")).alias("ts"))
    return (
        timed.groupBy("streamer", "category", F.to_date("ts").alias("day"))
        .agg(F.min("ts").alias("session_start"), F.max("ts").alias("session_end"))
        .drop("day")
    )


def probation_gate(spark, sf_dir):
    envelope = bronze(spark, sf_dir)
    return gate.qualify(envelope, daily_sessions(envelope), seconds=GATE_SECONDS)


def daily_session_summary(spark, sf_dir):
    envelope = bronze(spark, sf_dir)
    return sessions.session_summary(envelope, daily_sessions(envelope))


def registry_log(spark, sf_dir):
    return zoned(spark_input(spark, sf_dir, inputs.REGISTRY_LOG), "ts")


def registry_state(spark, sf_dir, cooldown="last"):
    return registry.fold_registry(registry_log(spark, sf_dir), cooldown=cooldown)


def actionable(spark, sf_dir):
    log = registry_log(spark, sf_dir)
    busy = log.where((F.col("op") == "stream_end") & (F.col("ts") >= F.expr(NOW) - F.expr("interval 8 hours")))
    active = busy.select(F.upper("handle").alias("username"))
    return registry.actionable(registry.fold_registry(log), active, F.expr(NOW))


def check_inputs(spark, sf_dir):
    return zoned(spark_input(spark, sf_dir, inputs.CHECKS), "ts")


def discoveries(spark, sf_dir):
    return spider.discover(battles(spark, sf_dir), spark_input(spark, sf_dir, inputs.CREATORS))


def reach(spark, sf_dir):
    seeds = spark_input(spark, sf_dir, inputs.CREATORS).where("username in ('s0', 's5')")
    return spider.discover_reach(battles(spark, sf_dir, inputs.CHAIN_BATTLES), seeds)


def spider_registry(spark, sf_dir):
    """The pool as added first, then what the battles tell, folded: known general creators can be upgraded."""
    creators = spark_input(spark, sf_dir, inputs.CREATORS)
    added = creators.select(
        F.lit(-1).cast("bigint").alias("seq"), F.col("username").alias("handle"), F.lit("add").alias("op"),
        "category", "archetype", F.lit("seed").alias("source"),
    )
    told = spider.meeting_events(battles(spark, sf_dir), creators)
    folded = registry.fold_registry(registry.as_registry_events(added).unionByName(told))
    return folded.select("username", "category", "archetype", "source", "status", "first_seq")


def partitions(spark, sf_dir):
    messages = to_messages(bronze(spark, sf_dir))
    placed = messages.withColumns(archive_columns(F.col("topic"), F.get_json_object("value", "$.received_at")))
    return placed.groupBy("topic", "year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("messages"))


def job(name: str):
    """``build(spark, sf_dir, root)`` run anew at every call, in a folder of its own; gives the folder."""
    def decorate(build):
        def folder(spark, sf_dir):
            root = scratch(spark, name)
            build(spark, sf_dir, root)
            return root

        return folder

    return decorate


@job("archive")
def archive_of(spark, sf_dir, root):
    """All messages in the hourly archive."""
    write_archive(to_messages(bronze(spark, sf_dir)), root, batch_id=0, rebalance=True)


def archived_days(spark, sf_dir):
    """Every event through the archive and back, counted per folder day."""
    events = read_all_days(spark, archive_of(spark, sf_dir)).withColumn(
        "event_type", F.get_json_object("value", "$.event_type")
    )
    gifts = F.when(
        F.col("event_type") == "gift",
        F.get_json_object("value", "$.data.diamond_count").cast("bigint"),
    )
    return events.groupBy("topic", "year", "month", "day", "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.coalesce(F.sum(gifts), F.lit(0)).alias("diamonds")
    )


def archived_gifts(spark, sf_dir):
    """Typed gifts out of the archive: the same rows as without it."""
    return typed(good(parse_envelopes(read_all_days(spark, archive_of(spark, sf_dir)))), "gift")


@job("live")
def live_tables_of(spark, sf_dir, root):
    """The damaged lines through the routing query."""
    spark_input(spark, sf_dir, inputs.LINES).select("value").write.text(f"{root}/in")
    query = start_live(file_lines(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint")
    query.awaitTermination()


@job("heartbeat")
def heartbeat_stream_of(spark, sf_dir, root):
    """All envelopes through the windowed streaming counts."""
    bronze(spark, sf_dir).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(ENVELOPE).parquet(f"{root}/in")
    start_heartbeat(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()


def heartbeat_stream(spark, sf_dir):
    """All windows, early, late and open ones."""
    return read_heartbeat(spark, f"{heartbeat_stream_of(spark, sf_dir)}/out")


def registry_in_steps(spark, sf_dir):
    """The first half of the log folded and stored, the second half folded into it."""
    log = registry_log(spark, sf_dir)
    middle = log.agg(F.floor((F.min("seq") + F.max("seq")) / 2)).first()[0]
    first = cut_lineage(registry.fold_registry(log.where(F.col("seq") <= middle)))
    return registry.fold_registry(log.where(F.col("seq") > middle), first)


DRY_DAY, CORRECTED_DAY = "2024-01-05", "2024-01-06"


def _every_day(spark, sf_dir):
    """The days that the messages have, in order."""
    day = F.substring("received_at", 1, 10).alias("day")
    return [r.day for r in bronze(spark, sf_dir).select(day).distinct().orderBy("day").collect()]


def _run_nights(spark, sf_dir, root, days):
    """A nightly run for each of ``days`` out of the archive of all messages, then one more of a day whose gifts have
    been taken out of the archive."""
    every = bronze(spark, sf_dir)
    write_archive(to_messages(every), f"{root}/lake", batch_id=0, rebalance=True)
    for day in days:
        run_nightly(spark, f"{root}/lake", day, out_root=f"{root}/out")
    taken_out = (F.substring("received_at", 1, 10) == CORRECTED_DAY) & (F.col("event_type") == "gift")
    corrected = every.where(~F.coalesce(taken_out, F.lit(False)))
    write_archive(to_messages(corrected), f"{root}/corrected", batch_id=0, rebalance=True)
    run_nightly(spark, f"{root}/corrected", CORRECTED_DAY, out_root=f"{root}/out")


@job("nightly")
def nightly_of(spark, sf_dir, root):
    _run_nights(spark, sf_dir, root, _every_day(spark, sf_dir))


def _nightly_rows(spark, root):
    parts = [
        read_nightly(spark, root, table)
        .groupBy("year", "month", "day", "category", "streamer")
        .agg(F.count(F.lit(1)).alias("n"), F.min("event_timestamp").alias("first_event"))
        .withColumn("item", F.lit(table))
        for table in TABLES.values()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def nightly_run(spark, sf_dir):
    """A nightly run for every day that the messages have, one of them corrected and run again."""
    return _nightly_rows(spark, f"{nightly_of(spark, sf_dir)}/out")


def nightly_dry_run(spark, sf_dir):
    """One day out of the archive of all messages."""
    return run_nightly(spark, archive_of(spark, sf_dir), DRY_DAY, dry_run=True).select("date", "item", "rows")


@job("undated")
def undated_of(spark, sf_dir, root):
    """All lines, damaged and undated ones included, archived; then the undated job."""
    lines = spark_input(spark, sf_dir, inputs.LINES).select(F.lit("live.events.mixed").alias("topic"), "value")
    write_archive(lines, f"{root}/lake", batch_id=0, rebalance=True)
    run_undated(spark, f"{root}/lake", f"{root}/out")


def nightly_quarantine(spark, sf_dir):
    return read_undated_quarantine(spark, f"{undated_of(spark, sf_dir)}/out")


@job("local")
def local_of(spark, sf_dir, root):
    append_jsonl(bronze(spark, sf_dir), f"{root}/in")
    run_local(spark, f"{root}/in", f"{root}/out")


def local_run(spark, sf_dir):
    root = f"{local_of(spark, sf_dir)}/out"
    parts = [
        spark.read.parquet(f"{root}/silver_{table}")
        .groupBy("streamer")
        .agg(F.count(F.lit(1)).alias("n"), F.max("event_timestamp").alias("last_event"))
        .withColumn("item", F.lit(table))
        for table in (TABLES[kind] for kind in LOCAL_KINDS)
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@job("gate-stream")
def gate_stream_of(spark, sf_dir, root):
    """Events and sessions in three parts, by time, through the streaming gate; then a message of a later time."""
    envelope = bronze(spark, sf_dir)
    told = cut_lineage(daily_sessions(envelope))
    messages = envelope.unionByName(stream_gate.control_messages(told))
    at = event_time(F.col("received_at"))
    later = spark.createDataFrame([(None, None, None, "tick", "2030-01-01T00:00:00Z", "{}")], ENVELOPE)
    cuts = ["2000-01-01", "2024-01-11", "2024-01-21", "2029-01-01"]
    # Derived once: the part is the number of cuts that a message has passed.
    passed = functools.reduce(Column.__add__, [(at >= F.lit(cut)).cast("int") for cut in cuts])
    messages.withColumn("part", passed).write.partitionBy("part").parquet(f"{root}/parts")
    derived = spark.read.schema(T.StructType([*ENVELOPE.fields, T.StructField("part", T.IntegerType())])).parquet(f"{root}/parts")
    parts = [derived.where(F.col("part") == k).drop("part") for k in range(1, len(cuts))]
    for part in [*parts, later]:
        part.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(ENVELOPE).parquet(f"{root}/in")
        stream_gate.start_gate(stream, f"{root}/out", f"{root}/checkpoint", seconds=GATE_SECONDS).awaitTermination()


def probation_stream(spark, sf_dir):
    root = gate_stream_of(spark, sf_dir)
    decided = stream_gate.watermark(spark, f"{root}/checkpoint")
    return stream_gate.verdicts(spark, f"{root}/out", decided, seconds=GATE_SECONDS)


def configured_registry(spark, sf_dir):
    """Built-in creators, configuration documents of the customers by nation, and one creator added by hand."""
    path = scratch(spark, "config")
    listed = spark_input(spark, sf_dir, inputs.CONFIGURED)
    documents = listed.groupBy("category", "document").agg(F.array_sort(F.collect_list("name")).alias("streamers"))
    lines = documents.select(
        F.to_json(F.struct(F.create_map("category", F.struct("streamers")).alias("categories"))).alias("value")
    )
    lines.write.text(path)
    events = (
        registry.seed_events(spark)
        .unionByName(config_adds(read_config(spark, path, multi_line=False), first_seq=100))
        .unionByName(registry.manual_add(spark, "@Added_By_Hand", "npc", seq=10**9))
    )
    return registry.fold_registry(events).select("username", "category", "archetype", "source", "status")


def registry_snapshot(spark, sf_dir):
    """The registry through the snapshot's documents and back."""
    path = scratch(spark, "snapshot")
    write_snapshot(registry_state(spark, sf_dir), path, per_document=100)
    return read_snapshot(spark, path, multi_line=False)


def catalog_tables(spark, sf_dir):
    """The typed tables replaced twice in a catalog, read back by name."""
    database = f"roomtide_{uuid.uuid4().hex[:12]}"
    spark.sql(f"create database {database} location '{scratch(spark, database)}'")
    for _ in range(2):
        names = materialise({t: silver(spark, sf_dir, t) for t in TABLES.values()}, database)
    counted = [
        spark.table(name).groupBy("streamer").agg(F.count(F.lit(1)).alias("n"), F.max("event_timestamp").alias("last_event"))
        .withColumn("item", F.lit(table))
        for name, table in zip(names, TABLES.values())
    ]
    return functools.reduce(DataFrame.unionByName, counted)


@job("distinct")
def distinct_of(spark, sf_dir, root):
    """The damaged lines in two parts through the routing query; the second repeats a fifth of the first, twice."""
    lines = spark_input(spark, sf_dir, inputs.LINES)
    first, second = (lines.where(F.col("event_id") % 2 == part) for part in (0, 1))
    again = first.where(F.col("event_id") % 5 == 0)
    for part in (first.unionByName(again), second.unionByName(again)):
        part.select("value").write.mode("append").text(f"{root}/in")
        start_live(file_lines(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint", optional_dedup="30 days").awaitTermination()


def distinct_stream(spark, sf_dir):
    root = f"{distinct_of(spark, sf_dir)}/out"
    counted = [
        read_live(spark, root, table).groupBy("streamer").agg(F.count(F.lit(1)).alias("n")).withColumn("item", F.lit(table))
        for table in TABLES.values()
    ]
    return functools.reduce(DataFrame.unionByName, counted)


@job("session-states")
def session_states_of(spark, sf_dir, root):
    """All envelopes in three parts, the newest first, as session totals; the first two folded."""
    day = F.dayofmonth(event_time(F.col("received_at")))
    for part in (2, 0, 1):
        bronze(spark, sf_dir).where(day % 3 == part).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(ENVELOPE).parquet(f"{root}/in")
        states.start_sessions(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    states.compact_sessions(spark, f"{root}/out", upto=1)


def session_summary_stream(spark, sf_dir):
    return states.read_sessions(spark, f"{session_states_of(spark, sf_dir)}/out")


def likes_by_stretch(spark, sf_dir):
    """Running like totals of two stretches of time, each read without what came before it."""
    root = scratch(spark, "likes")
    likes = zoned(spark_input(spark, sf_dir, inputs.LIKES_WITH_GAPS), "event_timestamp")
    for part in range(3):
        states.write_likes(likes.where(F.col("event_id") % 3 == part), root, part, ("event_id",))
    states.compact_likes(likes, root, 1, ("event_id",))
    low, high = likes.agg(*[F.floor(F.unix_seconds(f("event_timestamp")) / 300) for f in (F.min, F.max)]).first()
    cut = (low + high) // 2
    parts = [states.carried_likes(likes, root, a, b, ("event_id",)) for a, b in ((low, cut), (cut, high + 1))]
    return parts[0].unionByName(parts[1])


@job("repairs")
def repaired_of(spark, sf_dir, root):
    """The damaged lines in two batches; lines with a damaged time are corrected, and the repair is repeated."""
    lines = spark_input(spark, sf_dir, inputs.LINES)
    for part in range(2):
        lines.where(F.col("event_id") % 2 == part).select("value").write.mode("append").text(f"{root}/in")
        start_live(file_lines(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    right = F.replace("value", F.lit('"received_at":"x'), F.lit('"received_at":"'))
    corrected = lines.select(F.col("value").alias("raw"), right.alias("value"))
    for _ in range(2):
        repairs.repair_quarantine(spark, f"{root}/out", corrected)


def quarantine_repaired(spark, sf_dir):
    """What the live tables hold after the repairs, and what still waits."""
    root = f"{repaired_of(spark, sf_dir)}/out"
    left = repairs.waiting(spark, root).groupBy(F.col("reason").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    for table in TABLES.values():
        rows = repairs.read_with_repairs(spark, root, table)
        left = left.unionByName(rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(table).alias("item"), "n"))
    return left


@job("registry-stream")
def registry_stream_of(spark, sf_dir, root):
    """The log in three parts, each arriving after the one before has been folded."""
    log = registry.as_registry_events(registry_log(spark, sf_dir))
    low, high = log.agg(F.min("seq"), F.max("seq")).first()
    for part in range(3):
        share = F.floor((F.col("seq") - low) * 3 / (high - low + 1))
        log.where(share == part).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(REGISTRY_EVENTS).parquet(f"{root}/in")
        start_registry(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()


def registry_stream(spark, sf_dir):
    return read_latest(spark, f"{registry_stream_of(spark, sf_dir)}/out")


@job("archive-stream")
def archive_stream_of(spark, sf_dir, root):
    """All messages through the streaming archive."""
    messages = to_messages(bronze(spark, sf_dir))
    messages.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(messages.schema).parquet(f"{root}/in")
    start_archive(stream, f"{root}/out", f"{root}/checkpoint", every=None).awaitTermination()


def archive_stream(spark, sf_dir):
    stored = read_all_days(spark, f"{archive_stream_of(spark, sf_dir)}/out")
    return stored.select("topic", "value", "year", "month", "day", "hour")


@job("compacted")
def compacted_of(spark, sf_dir, root):
    """The damaged lines through the routing query in three batches, views kept up, the first two batches folded."""
    lines, out, checkpoint = spark_input(spark, sf_dir, inputs.LINES), f"{root}/out", f"{root}/checkpoint"
    for part in range(3):
        lines.where(F.col("event_id") % 3 == part).select("value").write.mode("append").text(f"{root}/in")
        start_live(file_lines(spark, f"{root}/in"), out, checkpoint, also=views.write_partials).awaitTermination()
        if part:
            for table in TABLES.values():
                compact_live(spark, out, table, upto=part - 1, checkpoint=checkpoint)
            for name in views.VIEWS:
                views.compact_view(spark, out, name, upto=part - 1, checkpoint=checkpoint)


def live_view(spark, sf_dir, name):
    """A view read from the stream's partial aggregates, of which two batches are folded and one is open."""
    return views.read_view(spark, f"{compacted_of(spark, sf_dir)}/out", name)


# A year after the middle of the data, so that the cut falls into a month.
EXPIRY_NOW = datetime(2025, 1, 15, 12)


def live_retention(spark, sf_dir):
    """What the live tables hold after two batches are folded, the third is folded with the cut, and expired rows go."""
    out = f"{compacted_of(spark, sf_dir)}/out"
    parts = []
    for table in TABLES.values():
        drop_expired(spark, out, table, EXPIRY_NOW)
        compact_live(spark, out, table, upto=2, expire_before=years_before(EXPIRY_NOW, 1))
        counted = read_live(spark, out, table).groupBy("streamer", F.to_date("event_timestamp").alias("day"))
        parts.append(counted.agg(F.count(F.lit(1)).alias("n")).withColumn("item", F.lit(table)))
    return functools.reduce(DataFrame.unionByName, parts)


def live_routing(spark, sf_dir):
    root = f"{live_tables_of(spark, sf_dir)}/out"
    counted = [
        read_live(spark, root, table).groupBy("yyyymm").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(table).alias("item"), "yyyymm", "n")
        for table in TABLES.values()
    ]
    bad = read_quarantine(spark, root).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    result = bad.select(F.col("reason").alias("item"), F.lit(None).cast("string").alias("yyyymm"), "n")
    for part in counted:
        result = result.unionByName(part)
    return result


def live_whales(spark, sf_dir):
    """Over live tables of which two batches are compacted and one is open."""
    return gold.whale_analytics(read_live(spark, f"{compacted_of(spark, sf_dir)}/out", "gifts"))


def cast_edges(spark, sf_dir):
    raw = spark_input(spark, sf_dir, inputs.CAST_EDGES)
    return raw.select(
        "event_id", to_bigint(F.col("number_text")).alias("number"), to_flag(F.col("flag_text")).alias("flag"),
        event_time(F.col("time_text")).alias("at_time"),
    )


def room_defaults(spark, sf_dir):
    raw = spark_input(spark, sf_dir, inputs.RAW_ROOM)
    shown = shown_pins(raw).select("event_id", F.lit(True).alias("pin"))
    filled = with_room_defaults(with_like_defaults(raw)).withColumn(
        "comment_text", comment_text(F.col("comment"), F.col("content"))
    )
    return filled.join(shown, "event_id", "left").select(
        "event_id", "comment_text", "batch_count", "total_room_likes", "viewer_count", "popularity",
        F.coalesce("pin", F.lit(False)).alias("pin"),
    )


def user_identity(spark, sf_dir):
    raw = spark_input(spark, sf_dir, inputs.RAW_USERS)
    keep = ["c_custkey", "resolved_id", "resolved_handle", "resolved_nickname"]
    both = [
        with_user_identity(raw, variant).select(F.lit(variant).alias("variant"), *keep)
        for variant in ("daemon", "local")
    ]
    return both[0].unionByName(both[1])


def gift_defaults(spark, sf_dir):
    raw = spark_input(spark, sf_dir, inputs.RAW_GIFTS)
    keep = ["l_orderkey", "l_linenumber", "resolved_gift_id", "resolved_name", "resolved_diamonds", "resolved_repeat"]
    both = [
        with_gift_defaults(raw, variant).select(F.lit(variant).alias("variant"), *keep)
        for variant in ("daemon", "local")
    ]
    return both[0].unionByName(both[1])


def handles(spark, sf_dir):
    raw = spark_input(spark, sf_dir, inputs.RAW_HANDLES)
    return raw.select("c_custkey", normalize_handle(F.col("handle")).alias("username")).where("username is not null")


def carried_likes(spark, sf_dir):
    likes = zoned(spark_input(spark, sf_dir, inputs.LIKES_WITH_GAPS), "event_timestamp")
    return sessions.carry_like_total(likes, tie_break=("event_id",))


def _pure(build):
    return lambda spark, sf_dir: naive(build(spark, sf_dir))


def queries():
    named = {
        "whale_analytics": lambda s, d: gold.whale_analytics(silver(s, d, "gifts")),
        "streak_dynamics": lambda s, d: gold.streak_dynamics(silver(s, d, "gifts")),
        "vertical_performance": lambda s, d: gold.vertical_performance(silver(s, d, "product_pins")),
        "whale_analytics_facts": lambda s, d: gold.whale_analytics(gift_facts(s, d)),
        "streak_dynamics_facts": lambda s, d: gold.streak_dynamics(gift_facts(s, d)),
        "gift_revenue_facts": lambda s, d: gold.gift_revenue(gift_facts(s, d)),
        "event_overview": lambda s, d: gold.event_overview(bronze(s, d)),
        "event_breakdown": lambda s, d: gold.event_breakdown(bronze(s, d)),
        "event_types": lambda s, d: gold.event_types(bronze(s, d)),
        "event_total": lambda s, d: gold.row_count(bronze(s, d)),
        "viewer_metrics": lambda s, d: gold.viewer_metrics(silver(s, d, "room_viewers")),
        "top_likers": lambda s, d: gold.top_likers(silver(s, d, "likes")),
        "gift_revenue": lambda s, d: gold.gift_revenue(silver(s, d, "gifts")),
        "top_commenters": lambda s, d: gold.top_commenters(silver(s, d, "comments")),
        "live_whale_analytics": lambda s, d: gold.whale_analytics(silver(s, d, "gifts", "live")),
        "live_streak_dynamics": lambda s, d: gold.streak_dynamics(silver(s, d, "gifts", "live")),
        "live_vertical_performance": lambda s, d: gold.vertical_performance(silver(s, d, "product_pins", "live")),
        "user_identity": user_identity,
        "gift_defaults": gift_defaults,
        "room_defaults": room_defaults,
        "cast_edges": cast_edges,
        "handle_normalize": handles,
        "like_carry_forward": carried_likes,
        "session_summary": lambda s, d: sessions.session_summary(bronze(s, d)),
        "session_summary_stream": session_summary_stream,
        "likes_by_stretch": likes_by_stretch,
        "session_summary_daily": daily_session_summary,
        "session_bounds": lambda s, d: sessions.derive_sessions(bronze(s, d)),
        "session_top_gifts": lambda s, d: sessions.session_top(bronze(s, d), "gift"),
        "session_top_whales": lambda s, d: sessions.session_top(bronze(s, d), "gifter"),
        "heartbeat_rollup": lambda s, d: telemetry.heartbeat(bronze(s, d)),
        "heartbeat_breakdown": lambda s, d: telemetry.breakdown(telemetry.heartbeat(bronze(s, d))),
        "heartbeat_stream": heartbeat_stream,
        "probation_gate": probation_gate,
        "probation_stream": probation_stream,
        "check_classifier": lambda s, d: checks.classify_checks(check_inputs(s, d)),
        "live_summary": lambda s, d: checks.live_summary(registry_state(s, d), check_inputs(s, d)),
        "registry_state": registry_state,
        "registry_in_steps": registry_in_steps,
        "registry_snapshot": registry_snapshot,
        "configured_registry": configured_registry,
        "catalog_tables": catalog_tables,
        "distinct_stream": distinct_stream,
        "registry_state_max": lambda s, d: registry_state(s, d, "max"),
        "actionable_streamers": actionable,
        "candidate_listing": lambda s, d: registry.list_candidates(registry_state(s, d)),
        "battle_opponents": lambda s, d: spider.battle_opponents(battles(s, d)),
        "spider_discoveries": discoveries,
        "spider_reach": reach,
        "spider_registry": spider_registry,
        "topic_routing": lambda s, d: to_messages(bronze(s, d)),
        "bronze_partitions": partitions,
        "archived_days": archived_days,
        "nightly_slice": archived_gifts,
        "retention_cut": lambda s, d: retained(silver(s, d, "gifts", "live"), F.expr(RETENTION_NOW)),
        "quarantine": lambda s, d: quarantined(parse_envelopes(spark_input(s, d, inputs.LINES))),
        "live_routing": live_routing,
        "quarantine_repaired": quarantine_repaired,
        "live_stream_whales": live_whales,
        "live_view_whales": lambda s, d: live_view(s, d, "npc_whale_analytics"),
        "live_view_streaks": lambda s, d: live_view(s, d, "npc_streak_dynamics"),
        "live_view_verticals": lambda s, d: live_view(s, d, "ecommerce_vertical_performance"),
        "live_retention": live_retention,
        "nightly_run": nightly_run,
        "nightly_dry_run": nightly_dry_run,
        "nightly_quarantine": nightly_quarantine,
        "local_run": local_run,
        "registry_stream": registry_stream,
        "archive_stream": archive_stream,
    }
    for table in TABLES.values():
        named[f"silver_{table}"] = lambda s, d, t=table: silver(s, d, t)
        named[f"live_{table}"] = lambda s, d, t=table: silver(s, d, t, "live")
    for kind in LOCAL_KINDS:
        named[f"local_{TABLES[kind]}"] = lambda s, d, t=TABLES[kind]: silver(s, d, t, "local")
    return {name: _pure(build) for name, build in named.items()}
