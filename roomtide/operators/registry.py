"""The creator registry as a fold over an event log.

Events are ordered by ``seq``. ``op`` is one of add, offline, probation, stream_end, invalid; the
events of a creator before its first ``add`` do not count. Everything is an aggregate per creator,
combined on the map side, so neither order nor size of a creator's log matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.functions.identity import normalize_handle
from roomtide.operators.joins import join_unique
from roomtide.schemas import REGISTRY, REGISTRY_EVENTS

# Delays of the registry, in seconds.
OFFLINE_SECONDS = 180
CHECK_ERROR_SECONDS = 300
DEFAULT_REASON = "invalid_user"
STATUSES = ("blacklisted", "qualified", "cooldown")
STREAM_END_SECONDS = 15 * 60
FAILED_PROBATION_SECONDS = 3 * 3600
QUEUE_LIMIT = 10

# The starter creators with their category and archetype.
SEEDS = (
    ("manhuynn", "npc", "physical_challenge"),
    ("milktea_girl2", "npc", "pk_battler"),
    ("natuecoco", "npc", "pure_robotic"),
    ("halinhofficial", "ecommerce", "beauty"),
    ("maybelline_vn", "ecommerce", "beauty"),
    ("lorealparis_vn", "ecommerce", "beauty"),
    ("dirtycoins.vn", "ecommerce", "fashion"),
    ("routine_vietnam", "ecommerce", "fashion"),
    ("levents.vn", "ecommerce", "fashion"),
    ("fptshop.official", "ecommerce", "tech"),
    ("haidilaovietnam", "ecommerce", "food"),
)


def as_registry_events(df: DataFrame) -> DataFrame:
    """``df`` with the columns of the event log; missing ones are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in REGISTRY_EVENTS.fields
        ]
    )


def _adds(spark: SparkSession, rows: list[tuple[str, str, str]], source: str, first_seq: int) -> DataFrame:
    numbered = [(first_seq + i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, "seq bigint, handle string, category string, archetype string")
    return as_registry_events(
        df.withColumns({"op": F.lit("add"), "source": F.lit(source), "ts": F.current_timestamp()})
    )


def seed_events(spark: SparkSession, first_seq: int = 0) -> DataFrame:
    return _adds(spark, list(SEEDS), "seed", first_seq)


def config_events(spark: SparkSession, categories: dict[str, dict], first_seq: int = 0) -> DataFrame:
    """Adds from the ``categories`` part of a capture configuration (category -> streamers)."""
    rows = [
        (name, category, "general")
        for category, settings in categories.items()
        for name in settings.get("streamers", [])
    ]
    return _adds(spark, rows, "config_seed", first_seq)


def manual_add(spark: SparkSession, username: str, category: str = "npc", archetype: str = "general",
               seq: int = 0) -> DataFrame:
    return _adds(spark, [(username, category, archetype)], "cli_manual", seq)


def fold_registry(events: DataFrame, state: DataFrame | None = None, cooldown: str = "last",
                  fail_seconds: int = FAILED_PROBATION_SECONDS) -> DataFrame:
    """The registry after ``events``, starting from ``state`` (an earlier result) or from nothing.

    ``cooldown="last"``: the latest event sets the cooldown, even to an earlier time, as the capture
    service does. ``cooldown="max"``: a later event never shortens it; a passed probation clears it
    in either case.
    """
    if cooldown not in ("last", "max"):
        raise ValueError(f"cooldown must be 'last' or 'max', not {cooldown!r}")
    log = _prepared(as_registry_events(events), fail_seconds)
    is_add, is_pass = F.col("op") == "add", (F.col("op") == "probation") & F.col("passed")
    marks = log.groupBy("handle").agg(
        F.min(F.when(is_add, F.col("seq"))).alias("first_add"),
        F.max(F.when(is_pass, F.col("seq"))).alias("last_pass"),
    )
    if state is not None:
        known = state.select(F.col("username").alias("handle"), F.lit(True).alias("known"))
        marks = marks.join(known, "handle", "left")
    else:
        marks = marks.withColumn("known", F.lit(None).cast("boolean"))
    marks = marks.where(F.col("known") | F.col("first_add").isNotNull())
    counted = join_unique(log, marks, "handle", ["seq"]).where(
        F.col("known") | (F.col("seq") >= F.col("first_add"))
    )
    change = _change_per_creator(counted, cooldown)
    return _as_state(change) if state is None else _merge(state, change, cooldown)


def event_username() -> Column:
    """The username that an event's ``handle`` names: only adds strip an at sign."""
    return F.when(F.col("op") == "add", normalize_handle(F.col("handle"))).otherwise(F.lower("handle"))


def _prepared(events: DataFrame, fail_seconds: int) -> DataFrame:
    """Normalised handles, the status an event sets and the cooldown it sets."""
    op = F.col("op")
    events = events.withColumn("passed", F.coalesce("passed", F.lit(False)))
    seconds = (
        F.when(op == "offline", F.coalesce("delay_sec", F.lit(OFFLINE_SECONDS)))
        .when(op == "stream_end", F.lit(STREAM_END_SECONDS))
        .when((op == "probation") & ~F.col("passed"), F.lit(fail_seconds))
    )
    status = F.when(op == "invalid", F.lit("blacklisted")).when(
        op == "probation", F.when(F.col("passed"), F.lit("qualified")).otherwise(F.lit("cooldown"))
    )
    prepared = events.withColumns(
        {
            "handle": event_username(),
            "new_status": status,
            "new_cooldown": F.col("ts") + F.make_dt_interval(secs=seconds),
            "sets_cooldown": op.isin("offline", "stream_end", "probation"),
            "reason": F.when(op == "invalid", F.coalesce("reason", F.lit(DEFAULT_REASON))).otherwise(F.col("reason")),
        }
    )
    return prepared.where(F.col("handle").isNotNull())


def _change_per_creator(counted: DataFrame, cooldown: str) -> DataFrame:
    """One row per creator. The log itself is aggregated in numbers and times only, which hash; the texts are
    fetched from the few events that decide them."""
    seq, op = F.col("seq"), F.col("op")
    is_add, is_probation, is_invalid = op == "add", op == "probation", op == "invalid"

    def latest(value: Column, when: Column) -> Column:
        return F.max_by(value, F.when(when, seq))

    named = is_add & (F.col("archetype") != "general")
    if cooldown == "last":
        until = latest(F.col("new_cooldown"), F.col("sets_cooldown"))
    else:
        standing = F.col("last_pass").isNull() | (seq > F.col("last_pass"))
        until = F.max(F.when(F.col("sets_cooldown") & standing, F.col("new_cooldown")))
    codes = F.array(*[F.lit(status) for status in STATUSES])
    code = F.array_position(codes, F.col("new_status")).cast("int")
    change = counted.groupBy("handle").agg(
        F.min(F.when(is_add, seq)).alias("first_seq"),
        F.min(F.when(named, seq)).alias("named_seq"),
        F.max(F.when(is_invalid, seq)).alias("invalid_seq"),
        F.min_by(F.col("ts"), F.when(is_add, seq)).alias("discovered_at"),
        latest(code, F.col("new_status").isNotNull()).alias("status_code"),
        until.alias("cooldown_until"),
        F.bool_or("sets_cooldown").alias("sets_cooldown"),
        F.bool_or(is_probation & F.col("passed")).alias("passes"),
        F.count_if(is_probation).alias("total_sessions"),
        F.coalesce(F.max(F.when(is_probation, F.col("viewers"))), F.lit(0)).alias("peak_viewers"),
        F.coalesce(F.sum(F.when(is_probation, F.col("diamonds"))), F.lit(0)).alias("total_diamonds_seen"),
        latest(F.col("ts"), is_probation).alias("last_live"),
        latest(F.col("ts"), op == "offline").alias("last_checked"),
    )
    deciding = change.select(
        "handle", F.explode(F.array_compact(F.array_distinct(F.array("first_seq", "named_seq", "invalid_seq")))).alias("seq")
    )
    # At most three events of a creator, found by (handle, seq); a hot creator is no hot key here.
    texts = counted.join(deciding, ["handle", "seq"]).groupBy("handle").agg(
        F.collect_list(F.struct("seq", "op", "category", "source", "archetype", "reason")).alias("texts")
    )

    def text(field: str, kind: str, at: str) -> Column:
        rows = F.filter("texts", lambda t: (t["op"] == kind) & (t["seq"] == F.col(at)))
        return F.get(rows, F.lit(0))[field]

    return change.join(texts, "handle", "left").select(
        *[c for c in change.columns if c not in ("named_seq", "invalid_seq", "status_code")],
        F.get(codes, F.col("status_code") - 1).alias("status"),
        text("category", "add", "first_seq").alias("category"),
        text("source", "add", "first_seq").alias("source"),
        text("archetype", "add", "named_seq").alias("archetype"),
        text("reason", "invalid", "invalid_seq").alias("blacklist_reason"),
    )


def _as_state(change: DataFrame) -> DataFrame:
    defaults = {
        "username": F.col("handle"),
        "archetype": F.coalesce("archetype", F.lit("general")),
        "source": F.coalesce("source", F.lit("spider")),
        "status": F.coalesce("status", F.lit("candidate")),
        "peak_viewers": F.greatest(F.col("peak_viewers"), F.lit(0)),
    }
    return _registry_columns(change.withColumns(defaults))


def _merge(state: DataFrame, change: DataFrame, cooldown: str) -> DataFrame:
    both = state.alias("s").join(change.alias("c"), F.col("s.username") == F.col("c.handle"), "full")

    def old_first(name: str, default: str | None = None) -> Column:
        tail = [F.lit(default)] if default is not None else []
        return F.coalesce(f"s.{name}", f"c.{name}", *tail)

    def new_first(name: str, default: str | None = None) -> Column:
        tail = [F.lit(default)] if default is not None else []
        return F.coalesce(f"c.{name}", f"s.{name}", *tail)

    def number(name: str) -> tuple[Column, Column]:
        return F.coalesce(f"s.{name}", F.lit(0)), F.coalesce(f"c.{name}", F.lit(0))

    changed = F.coalesce("c.sets_cooldown", F.lit(False))
    until = F.when(changed, F.col("c.cooldown_until")).otherwise(F.col("s.cooldown_until"))
    if cooldown == "max":
        until = F.when(F.coalesce("c.passes", F.lit(False)), F.col("c.cooldown_until")).otherwise(
            F.greatest("c.cooldown_until", "s.cooldown_until")
        )
    old_archetype = F.nullif(F.col("s.archetype"), F.lit("general"))
    merged = both.select(
        F.coalesce("s.username", "c.handle").alias("username"),
        old_first("category").alias("category"),
        F.coalesce(old_archetype, F.col("c.archetype"), F.lit("general")).alias("archetype"),
        old_first("source", "spider").alias("source"),
        old_first("discovered_at").alias("discovered_at"),
        new_first("status", "candidate").alias("status"),
        until.alias("cooldown_until"),
        new_first("blacklist_reason").alias("blacklist_reason"),
        sum(number("total_sessions")).alias("total_sessions"),
        F.greatest(*number("peak_viewers")).alias("peak_viewers"),
        sum(number("total_diamonds_seen")).alias("total_diamonds_seen"),
        new_first("last_live").alias("last_live"),
        new_first("last_checked").alias("last_checked"),
        old_first("first_seq").alias("first_seq"),
    )
    return _registry_columns(merged)


def _registry_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REGISTRY.fields])


def actionable(registry: DataFrame, active: DataFrame, now: Column, limit: int = QUEUE_LIMIT) -> DataFrame:
    """The next creators to check: qualified ones first, then candidates, in order of discovery.

    ``active`` holds the usernames being captured. A cooldown that is absent or unreadable is over.
    The top-n keeps ``limit`` rows per task.
    """
    busy = active.select(F.lower("username").alias("username")).distinct()
    cooled = F.coalesce(now >= F.col("cooldown_until").try_cast("timestamp"), F.lit(True))
    status = F.coalesce("status", F.lit("candidate"))
    priority = F.when(status == "qualified", 1).when(status == "candidate", 2).otherwise(3)
    return (
        registry.where((status != "blacklisted") & cooled)
        .join(busy, "username", "left_anti")
        .withColumn("priority", priority)
        .orderBy("priority", "first_seq", "username")
        .limit(limit)
        .select("username", "category", "archetype", "priority", "first_seq")
    )


def list_candidates(registry: DataFrame) -> DataFrame:
    """The whole pool: qualified creators first, then by category, then by discovery."""
    unproven = F.when(F.col("status") == "qualified", 0).otherwise(1)
    return registry.orderBy(unproven, F.col("category").asc_nulls_last(), "first_seq", "username").select(
        "username", "category", "archetype", "status", "peak_viewers", "first_seq"
    )
