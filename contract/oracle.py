"""name -> DuckDB SQL over the same tables."""

from __future__ import annotations

from contract import inputs
from contract.inputs import duck

# Stated here and not taken from the code under test.
GATE_SECONDS, OFFLINE_SECONDS, STREAM_END_SECONDS, FAILED_PROBATION_SECONDS = 21_600, 180, 900, 10_800
NOW = "timestamp '2024-01-28 00:00:00'"
RETENTION_NOW = "timestamp '2025-01-16 12:00:00'"
TABLES = {
    "gift": "gifts", "comment": "comments", "like": "likes", "room_users": "room_viewers", "product_pin": "product_pins",
}
# The creators that a new registry begins with.
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
TOPIC_PREFIX = "live.events."

TS = "cast(cast(received_at as timestamptz) at time zone 'UTC' as timestamp)"
ARCHETYPE = "coalesce(nullif(archetype, ''), 'general')"


def key(name: str) -> str:
    return f"json_extract_string(data, '$.{name}')"


def big(name: str) -> str:
    return f"try_cast({key(name)} as bigint)"


def live_text(name: str) -> str:
    return f"case when json_type(data, '$.{name}') = 'VARCHAR' then {key(name)} else '' end"


def live_count(name: str) -> str:
    return f"greatest(coalesce(try_cast({key(name)} as bigint), 0), 0)"


HANDLE = f"coalesce({key('unique_id')}, {key('user')})"

COLUMNS = {
    "gifts": [
        ("user_id", key("user_id")), ("user_handle", HANDLE), ("nickname", key("nickname")),
        ("gift_id", big("gift_id")), ("gift_name", key("gift_name")), ("diamond_count", big("diamond_count")),
        ("repeat_count", big("repeat_count")),
        ("is_streaking", f"try_cast(coalesce({key('streaking')}, 'false') as boolean)"),
        ("is_repeat_end", f"try_cast(coalesce({key('repeat_end')}, 'false') as boolean)"),
        ("usd_value", f"try_cast({key('usd_value')} as double)"),
    ],
    "comments": [
        ("user_id", key("user_id")), ("user_handle", HANDLE), ("nickname", key("nickname")),
        ("comment_text", key("comment")),
    ],
    "likes": [
        ("user_id", key("user_id")), ("user_handle", HANDLE), ("batch_count", big("batch_count")),
        ("total_room_likes", big("total_room_likes")),
    ],
    "room_viewers": [
        ("viewer_count", big("viewer_count")),
        ("popularity", f"try_cast(coalesce({key('popularity')}, '0') as bigint)"),
    ],
    "product_pins": [
        ("product_id", key("product_id")), ("title", key("title")), ("price", key("price")),
        ("open_url", key("open_url")), ("live_product_count", big("live_product_count")),
    ],
}
LIVE_COLUMNS = {
    "gifts": [
        ("user_id", live_text("user_id")), ("unique_id", live_text("unique_id")), ("nickname", live_text("nickname")),
        ("gift_id", live_count("gift_id")), ("gift_name", live_text("gift_name")),
        ("diamond_count", live_count("diamond_count")), ("repeat_count", live_count("repeat_count")),
        ("is_streaking", f"coalesce(try_cast({key('streaking')} as boolean), false)"),
        ("is_repeat_end", f"coalesce(try_cast({key('repeat_end')} as boolean), false)"),
        ("usd_value", f"coalesce(try_cast({key('usd_value')} as double), 0.0::double)"),
    ],
    "comments": [
        ("user_id", live_text("user_id")), ("unique_id", live_text("unique_id")), ("nickname", live_text("nickname")),
        ("comment_text", live_text("comment")),
    ],
    "likes": [
        ("user_id", live_text("user_id")), ("unique_id", live_text("unique_id")),
        ("batch_count", live_count("batch_count")), ("total_room_likes", live_count("total_room_likes")),
    ],
    "room_viewers": [("viewer_count", live_count("viewer_count")), ("popularity", live_count("popularity"))],
    "product_pins": [
        ("product_id", live_text("product_id")), ("title", live_text("title")), ("price", live_text("price")),
        ("open_url", live_text("open_url")), ("live_product_count", live_count("live_product_count")),
        ("action_type", f"coalesce(try_cast({key('action_type')} as integer), 0)"),
    ],
}
KIND_OF = {table: kind for kind, table in TABLES.items()}


def typed_sql(table: str, mode: str = "batch", source: str = "bronze") -> str:
    ts = f"date_trunc('second', {TS})" if mode == "live" else TS
    columns = [("event_timestamp", ts), ("streamer", "streamer")]
    if mode != "local":
        columns += [("category", "category"), ("archetype", ARCHETYPE)]
    columns += (LIVE_COLUMNS if mode == "live" else COLUMNS)[table]
    listed = ", ".join(f"{expression} as {name}" for name, expression in columns)
    return f"select {listed} from {source} where event_type = '{KIND_OF[table]}'"


def with_bronze(body: str, **ctes: str) -> str:
    parts = [f"bronze as ({duck(inputs.BRONZE)})", *[f"{n} as ({sql})" for n, sql in ctes.items()]]
    return f"with recursive {', '.join(parts)} {body}"


def with_input(sql: str, body: str, **ctes: str) -> str:
    parts = [f"src as ({duck(sql)})", *[f"{n} as ({text})" for n, text in ctes.items()]]
    return f"with recursive {', '.join(parts)} {body}"


def whale(source: str, handle: str = "user_handle") -> str:
    return f"""select streamer, archetype, count(gifter) as total_unique_gifters,
 cast(sum(user_diamonds) as bigint) as total_diamonds, cast(max(user_diamonds) as bigint) as top_whale_diamonds,
 round(cast(max(user_diamonds) as double) / nullif(cast(sum(user_diamonds) as double), 0) * 100, 2) as top_whale_revenue_share_pct
 from (select streamer, archetype, {handle} as gifter, sum(diamond_count * repeat_count) as user_diamonds
  from {source} where category = 'npc' and is_streaking = false group by 1, 2, 3) w group by 1, 2"""


def streak(source: str) -> str:
    return f"""select streamer, archetype, gift_name, count(*) as total_gift_events,
 avg(repeat_count) as avg_combo_streak, max(repeat_count) as max_combo_streak,
 cast(sum(diamond_count * repeat_count) as bigint) as total_diamonds_generated
 from {source} where category = 'npc' and is_repeat_end group by 1, 2, 3"""


def vertical(source: str) -> str:
    return f"""select archetype as product_category, streamer, count(distinct product_id) as unique_products_showcased,
 count(*) as total_pin_events, min(event_timestamp) as session_start, max(event_timestamp) as session_last_pin
 from {source} where category = 'ecommerce' group by 1, 2"""


def revenue(source: str) -> str:
    return f"""select gift_name, count(*) as times_sent, cast(sum(diamond_count * repeat_count) as bigint) as total_diamonds,
 cast(round(cast(sum(diamond_count * repeat_count) as decimal(20,0)) * 0.005, 2) as double) as approx_usd
 from {source} where is_streaking = false group by 1"""


ACTIVITY = f"""select streamer, category, event_type, {TS} as ts, {HANDLE} as gifter, {key('gift_name')} as gift_name,
 coalesce({big('repeat_count')}, 1) as repeat_count,
 coalesce({big('diamond_count')}, 0) * coalesce({big('repeat_count')}, 1) as coins,
 event_type = 'gift' and not try_cast(coalesce({key('streaking')}, 'false') as boolean) as is_final,
 try_cast({key('usd_value')} as double) as usd_value, {big('viewer_count')} as viewers,
 {big('batch_count')} as taps, {big('total_room_likes')} as room_likes from bronze"""

DAILY = f"""select streamer, category, min({TS}) as session_start, max({TS}) as session_end from bronze
 group by streamer, category, cast({TS} as date)"""


def summary(source: str, keys: str, bounds: str) -> str:
    return f"""select *,
 case when duration_seconds > 0 then total_diamonds / (duration_seconds / 60.0::double) else 0 end as diamonds_per_min,
 case when duration_seconds > 0 then total_usd / (duration_seconds / 60.0::double) else 0 end as usd_per_min
 from (select {keys}, {bounds}
  cast(coalesce(sum(coins) filter (where is_final), 0) as bigint) as total_diamonds,
  coalesce(sum(usd_value) filter (where is_final), 0) + cast(coalesce(sum(coins) filter (where is_final and usd_value is null), 0) as double) * 0.005::double as total_usd,
  count(*) filter (where event_type = 'comment') as total_comments,
  coalesce(arg_max(viewers, ts) filter (where event_type = 'room_users'), 0) as last_viewer_count,
  coalesce(arg_max(room_likes, ts) filter (where event_type = 'like'), 0) as total_likes,
  epoch_us(max(session_end)) / 1000000.0::double - epoch_us(min(session_start)) / 1000000.0::double as _d,
  (epoch_us(max(session_end)) - epoch_us(min(session_start))) / 1000000.0::double as duration_seconds
  from {source} group by {keys}) t"""


def session_top(column: str, measure: str, total: str, n: int, extra: str = "") -> str:
    return with_bronze(
        f"""select * {extra} from (select streamer, {column}, {total},
 cast(row_number() over (partition by streamer order by {total} desc, {column} asc nulls last) as integer) as rank
 from (select streamer, {column}, cast(sum({measure}) as bigint) as {total} from activity where is_final group by 1, 2) a) r
 where rank <= {n}""",
        activity=ACTIVITY,
    )


KINDS = list(TABLES)
HEARTBEAT_CTES = {
    "timed": f"""select streamer, event_type, {TS} as ts,
 to_timestamp(cast(floor(epoch({TS}) / 300) as bigint) * 300) at time zone 'UTC' as w
 from bronze where event_type in ({', '.join(f"'{k}'" for k in KINDS)})""",
    "spine": """select cast(unnest(generate_series((select min(w) from timed), (select max(w) from timed),
 interval 5 minutes)) as timestamp) as w""",
    "counts": f"""select w, count(*) as events, count(distinct streamer) as active,
 {', '.join(f"count(*) filter (where event_type = '{k}') as n_{k}" for k in KINDS)} from timed group by 1""",
    "beats": f"""select spine.w as window_start, spine.w + interval 5 minutes as window_end,
 coalesce(active, 0) as active_streamers, cast(sum(coalesce(events, 0)) over r as bigint) as total_events,
 {', '.join(f"cast(sum(coalesce(n_{k}, 0)) over r as bigint) as {k}_total" for k in KINDS)},
 (epoch_us(spine.w + interval 5 minutes) - epoch_us((select min(ts) from timed))) / 1000000.0::double as uptime_seconds
 from spine left join counts on spine.w = counts.w window r as (order by spine.w rows unbounded preceding)""",
}

GATE = f"""select *, case when category = 'npc' then viewers >= 5 and (gifts > 0 or diamonds > 0 or comments >= 3)
 else has_shop_products or (viewers >= 5 and comments >= 1) end as is_qualified
 from (select s.streamer, s.category, s.session_start, s.session_end,
  coalesce(max(a.viewers) filter (where event_type = 'room_users'), 0) as viewers,
  cast(coalesce(sum(a.repeat_count) filter (where event_type = 'gift'), 0) as bigint) as gifts,
  cast(coalesce(sum(a.coins) filter (where event_type = 'gift'), 0) as bigint) as diamonds,
  count(*) filter (where event_type = 'comment') as comments,
  cast(coalesce(sum(a.taps) filter (where event_type = 'like'), 0) as bigint) as likes,
  coalesce(bool_or(event_type = 'product_pin'), false) as has_shop_products
  from daily s left join activity a on a.streamer = s.streamer and a.ts between s.session_start and s.session_start + interval {GATE_SECONDS} seconds
  where s.session_end >= s.session_start + interval {GATE_SECONDS} seconds
  group by 1, 2, 3, 4) m"""

SESSION_BOUNDS_CTES = {
    "t": f"select streamer, category, {TS} as ts from bronze",
    "o": """select *, case when lag(ts) over w is null or epoch_us(ts) - epoch_us(lag(ts) over w) > 900000000 then 1 else 0 end as opens
 from t window w as (partition by streamer, category order by ts)""",
    "n": """select *, sum(opens) over (partition by streamer, category order by ts rows unbounded preceding) as number from o""",
}


def fold(cooldown: str = "last") -> dict[str, str]:
    until = (
        "arg_max_null(until, seq) filter (where op in ('offline', 'stream_end', 'probation'))"
        if cooldown == "last"
        else "max(until) filter (where last_pass is null or seq > last_pass)"
    )
    return {
        "log": f"""select *, case when op = 'offline' then ts + to_seconds(coalesce(delay_sec, {OFFLINE_SECONDS}))
  when op = 'stream_end' then ts + to_seconds({STREAM_END_SECONDS})
  when op = 'probation' and not passed then ts + to_seconds({FAILED_PROBATION_SECONDS}) end as until,
 case when op = 'invalid' then 'blacklisted' when op = 'probation' then case when passed then 'qualified' else 'cooldown' end end as new_status,
 min(seq) filter (where op = 'add') over (partition by handle) as first_add,
 max(seq) filter (where op = 'probation' and passed) over (partition by handle) as last_pass from src""",
        "folded": f"""select handle as username, arg_min(category, seq) filter (where op = 'add') as category,
 coalesce(arg_min(archetype, seq) filter (where op = 'add' and archetype <> 'general'), 'general') as archetype,
 arg_min(source, seq) filter (where op = 'add') as source, arg_min(ts, seq) filter (where op = 'add') as discovered_at,
 coalesce(arg_max(new_status, seq) filter (where new_status is not null), 'candidate') as status,
 {until} as cooldown_until, arg_max(reason, seq) filter (where op = 'invalid') as blacklist_reason,
 count(*) filter (where op = 'probation') as total_sessions,
 coalesce(max(viewers) filter (where op = 'probation'), 0) as peak_viewers,
 cast(coalesce(sum(diamonds) filter (where op = 'probation'), 0) as bigint) as total_diamonds_seen,
 max(ts) filter (where op = 'probation') as last_live, max(ts) filter (where op = 'offline') as last_checked,
 min(seq) filter (where op = 'add') as first_seq from log where seq >= first_add group by 1""",
    }


CHECK_CTE = """select *, case when op_outcome = 'blacklist' then 'invalid' when op_outcome <> 'live' then 'offline' end as op,
 cast(case when op_outcome = 'offline' then 180 when op_outcome = 'error' then 300 end as bigint) as delay_sec,
 case when op_outcome = 'blacklist' then 'incapable_of_live' end as reason
 from (select *, case when error is not null then
   case when contains(lower(error), 'not capable of going live') or contains(lower(error), 'does not exist')
     or contains(lower(error), 'user_not_found') then 'blacklist' else 'error' end
  when is_live then 'live' else 'offline' end as op_outcome from src) c"""

TABLE_OF = f"map([{', '.join(f"'{k}'" for k in TABLES)}], [{', '.join(f"'{t}'" for t in TABLES.values())}])[event_type]"

# More than the longest chain of the derived battles.
HOPS = 14

OPPONENTS = """select distinct event_id as seq, ts, lower(host) as host, lower(opponent) as opponent
 from (select event_id, ts, host, unnest([anchor1, anchor2, anchor3, rival]) as opponent from src) u
 where opponent is not null and opponent <> '' and lower(opponent) <> lower(host)"""


def finds(hosts: str, known: str) -> str:
    """The first meeting makes the creator; the first that names an archetype settles it."""
    return f"""select username, arg_min(category, seq) as category,
 coalesce(arg_min(given, seq) filter (where given <> 'general'), 'general') as archetype,
 concat('pk_battle_@', arg_min(host, seq)) as source, min(seq) as seq
 from (select opponent as username, host, category, seq,
  case when category = 'npc' then 'pk_battler' else archetype end as given
  from opponents join {hosts} h on h.username = host) m
 where username not in (select username from {known}) group by 1"""


def message(head: list[str]) -> str:
    def quoted(column: str) -> str:
        return f"coalesce('\"' || {column} || '\"', 'null')"

    fields = ", ',', ".join(f"""'"{c}":', {quoted(c)}""" for c in head)
    return f"concat('{{', {fields}, ',\"data\":', data, '}}')"


def oracle_sql() -> dict[str, str]:
    sql = {}
    for table in TABLES.values():
        sql[f"silver_{table}"] = with_bronze(typed_sql(table))
        sql[f"live_{table}"] = with_bronze(typed_sql(table, "live"))
        if table != "product_pins":
            sql[f"local_{table}"] = with_bronze(typed_sql(table, "local"))
    gifts, live_gifts = {"t": typed_sql("gifts")}, {"t": typed_sql("gifts", "live")}
    sql["whale_analytics"] = with_bronze(whale("t"), **gifts)
    sql["streak_dynamics"] = with_bronze(streak("t"), **gifts)
    sql["vertical_performance"] = with_bronze(vertical("t"), t=typed_sql("product_pins"))
    sql["live_whale_analytics"] = with_bronze(whale("t", "unique_id"), **live_gifts)
    sql["live_streak_dynamics"] = with_bronze(streak("t"), **live_gifts)
    sql["live_vertical_performance"] = with_bronze(vertical("t"), t=typed_sql("product_pins", "live"))
    sql["gift_revenue"] = with_bronze(revenue("t"), **gifts)
    sql["whale_analytics_facts"] = with_input(inputs.GIFT_FACTS, whale("src"))
    sql["streak_dynamics_facts"] = with_input(inputs.GIFT_FACTS, streak("src"))
    sql["gift_revenue_facts"] = with_input(inputs.GIFT_FACTS, revenue("src"))
    sql["event_overview"] = with_bronze(
        f"select event_type, count(*) as total_records, min({TS}) as first_event, max({TS}) as last_event from bronze group by 1"
    )
    sql["event_breakdown"] = with_bronze("select event_type, count(*) as cnt from bronze group by 1")
    sql["event_types"] = with_bronze("select distinct event_type from bronze")
    sql["event_total"] = with_bronze("select count(*) as total from bronze")
    sql["viewer_metrics"] = with_bronze(
        """select streamer, min(viewer_count) as min_viewers, round(avg(viewer_count), 1) as avg_viewers,
 max(viewer_count) as peak_viewers, count(*) as snapshot_intervals from t group by 1""",
        t=typed_sql("room_viewers"),
    )
    sql["top_likers"] = with_bronze(
        """select user_handle, cast(sum(batch_count) as bigint) as total_taps_contributed, count(*) as tap_batches_sent,
 round(avg(batch_count), 1) as avg_batch_size from t group by 1
 order by total_taps_contributed desc, user_handle asc nulls last limit 5""",
        t=typed_sql("likes"),
    )
    sql["top_commenters"] = with_bronze(
        """select user_handle, count(*) as total_comments from t group by 1
 order by total_comments desc, user_handle asc nulls last limit 5""",
        t=typed_sql("comments"),
    )
    sql["user_identity"] = with_input(
        inputs.RAW_USERS,
        """select 'daemon' as variant, c_custkey, cast(id as varchar) as resolved_id,
 coalesce(nullif(display_id, ''), nullif(unique_id, ''), nickname, 'anonymous') as resolved_handle,
 coalesce(nickname, 'anonymous') as resolved_nickname from src
 union all select 'local', c_custkey, cast(coalesce(id, user_id) as varchar), h, coalesce(nullif(nickname, ''), h)
 from (select *, coalesce(nullif(display_id, ''), nullif(unique_id, ''), nullif(nickname, ''), cast(id as varchar), 'anonymous') as h from src) l""",
    )
    sql["gift_defaults"] = with_input(
        inputs.RAW_GIFTS,
        """select 'daemon' as variant, l_orderkey, l_linenumber, cast(event_gift_id as varchar) as resolved_gift_id,
 coalesce(gift_name, 'Unknown') as resolved_name, coalesce(diamond_count, 0) as resolved_diamonds,
 coalesce(nullif(repeat_count, 0), 1) as resolved_repeat from src
 union all select 'local', l_orderkey, l_linenumber, cast(coalesce(nullif(event_gift_id, 0), gift_id) as varchar),
 coalesce(nullif(gift_name, ''), concat('Gift_', coalesce(cast(event_gift_id as varchar), 'unknown'))),
 coalesce(diamond_count, 0), coalesce(repeat_count, 1) from src""",
    )
    sql["room_defaults"] = with_input(
        inputs.RAW_ROOM,
        """select event_id, coalesce(nullif(comment, ''), content, '') as comment_text, coalesce(batch_count, 1) as batch_count,
 coalesce(total_room_likes, 0) as total_room_likes, coalesce(viewer_count, 0) as viewer_count,
 coalesce(popularity, 0) as popularity, pop_product is not null as pin from src""",
    )
    # The expected values, by the same remainders.
    sql["cast_edges"] = """select event_id,
 case event_id % 8 when 0 then 6 when 1 then 1000 when 3 then -6 when 5 then 12 when 7 then event_id end as number,
 case event_id % 7 when 0 then true when 2 then true when 3 then false when 6 then false end as flag,
 case event_id % 6 when 0 then timestamp '2024-01-05 04:07:08' when 3 then timestamp '2024-01-05 00:00:00'
  when 4 then timestamp '2024-01-05 06:07:08.5' end as at_time from events"""
    sql["handle_normalize"] = with_input(
        inputs.RAW_HANDLES,
        """select c_custkey, lower(ltrim(trim(handle), '@')) as username from src
 where ltrim(trim(handle), '@') <> ''""",
    )
    sql["like_carry_forward"] = with_input(
        inputs.LIKES_WITH_GAPS,
        """select event_id, event_timestamp, streamer, coalesce(last_value(total_room_likes ignore nulls) over
 (partition by streamer order by event_timestamp, event_id rows unbounded preceding), 0) as total_room_likes from src""",
    )
    sql["session_summary"] = with_bronze(
        f"select * exclude (_d) from ({summary('a', 'streamer', 'min(ts) as session_start, max(ts) as session_end,')}) z",
        activity=ACTIVITY,
        a="select *, ts as session_start, ts as session_end from activity",
    )
    sql["session_summary_stream"] = sql["session_summary"]
    sql["likes_by_stretch"] = sql["like_carry_forward"]
    sql["session_summary_daily"] = with_bronze(
        f"select * exclude (_d) from ({summary('a', 'streamer, session_start, session_end', '')}) z",
        activity=ACTIVITY,
        daily=DAILY,
        a="""select x.*, d.session_start, d.session_end from activity x join daily d
 on x.streamer = d.streamer and x.ts between d.session_start and d.session_end""",
    )
    sql["session_bounds"] = with_bronze(
        """select streamer, category, min(ts) as session_start, max(ts) as session_end from n
 group by streamer, category, number""",
        **SESSION_BOUNDS_CTES,
    )
    sql["session_top_gifts"] = session_top("gift_name", "repeat_count", "times", 5)
    sql["session_top_whales"] = session_top(
        "gifter", "coins", "diamonds", 3,
        ", cast(round(cast(diamonds as decimal(20,0)) * 0.005, 2) as double) as approx_usd",
    )
    sql["heartbeat_rollup"] = with_bronze("select *, total_events / uptime_seconds as eps from beats", **HEARTBEAT_CTES)
    sql["heartbeat_breakdown"] = with_bronze(
        " union all ".join(
            f"select window_start, '{k}' as event_type, {k}_total as total from beats where {k}_total > 0" for k in KINDS
        ),
        **HEARTBEAT_CTES,
    )
    counted = ", ".join(f"n_{k} as \"{k}\"" for k in KINDS)
    sql["heartbeat_stream"] = with_bronze(
        f"select w as window_start, events, {counted} from counts",
        timed=HEARTBEAT_CTES["timed"],
        counts=HEARTBEAT_CTES["counts"],
    )
    sql["probation_gate"] = with_bronze(GATE, activity=ACTIVITY, daily=DAILY)
    sql["probation_stream"] = sql["probation_gate"]
    sql["check_classifier"] = with_input(
        inputs.CHECKS, "select * exclude (op_outcome), op_outcome as outcome from c", c=CHECK_CTE
    )
    sql["live_summary"] = (
        f"with checks as ({duck(inputs.CHECKS)}), reg as ({with_input(inputs.REGISTRY_LOG, 'select * from folded', **fold())}), "
        """last as (select * from checks qualify row_number() over (partition by username order by seq desc) = 1)
 select (select count(*) from reg join last using (username)
  where reg.status <> 'blacklisted' and last.error is null and last.is_live) as live_now,
 (select count(*) from reg) as total_candidates"""
    )
    for name, cooldown in (("registry_state", "last"), ("registry_in_steps", "last"), ("registry_state_max", "max")):
        sql[name] = with_input(inputs.REGISTRY_LOG, "select * from folded", **fold(cooldown))
    sql["actionable_streamers"] = with_input(
        inputs.REGISTRY_LOG,
        f"""select username, category, archetype,
 case status when 'qualified' then 1 when 'candidate' then 2 else 3 end as priority, first_seq from folded
 where status <> 'blacklisted' and (cooldown_until is null or {NOW} >= cooldown_until)
 and username not in (select handle from src where op = 'stream_end' and ts >= {NOW} - interval 8 hours)
 order by priority, first_seq limit 10""",
        **fold(),
    )
    sql["candidate_listing"] = with_input(
        inputs.REGISTRY_LOG,
        "select username, category, archetype, status, peak_viewers, first_seq from folded",
        **fold(),
    )
    sql["battle_opponents"] = with_input(inputs.BATTLES, OPPONENTS)
    sql["spider_discoveries"] = with_input(
        inputs.BATTLES, "select * from found",
        opponents=OPPONENTS, creators=duck(inputs.CREATORS), found=finds("creators", "creators"),
    )
    sql["spider_registry"] = with_input(
        inputs.BATTLES,
        """select username, category, coalesce(nullif(archetype, 'general'), named, 'general') as archetype, 'seed' as source,
 'candidate' as status, cast(-1 as bigint) as first_seq
 from creators left join (select opponent as username, arg_min(given, seq) filter (where given <> 'general') as named
  from told group by 1) t using (username)
 union all select username, category, archetype, source, 'candidate', seq from found""",
        opponents=OPPONENTS, creators=duck(inputs.CREATORS), found=finds("creators", "creators"),
        told="""select opponent, seq, case when category = 'npc' then 'pk_battler' else archetype end as given
 from opponents join creators h on h.username = host""",
    )
    columns = "username, category, archetype, source"
    sql["spider_reach"] = with_input(
        inputs.CHAIN_BATTLES, f"select * from r{HOPS}",
        opponents=OPPONENTS,
        r0=f"select username, category, archetype, 'seed' as source, 0 as hop from ({duck(inputs.CREATORS)}) c where username in ('s0', 's5')",
        **{
            f"r{i}": f"select * from r{i - 1} union all select {columns}, {i} as hop from ("
            + finds(f"(select * from r{i - 1} where hop = {i - 1})", f"r{i - 1}") + ") f"
            for i in range(1, HOPS + 1)
        },
    )
    head = ["streamer", "category", "archetype", "event_type", "received_at"]
    sql["topic_routing"] = with_bronze(
        f"select concat('{TOPIC_PREFIX}', category) as topic, {message(head)} as value from bronze"
    )
    parts = f"""strftime({TS}, '%Y') as year, strftime({TS}, '%m') as month, strftime({TS}, '%d') as day"""
    topic = f"concat('{TOPIC_PREFIX}', category) as topic"
    sql["bronze_partitions"] = with_bronze(
        f"select {topic}, {parts}, strftime({TS}, '%H') as hour, count(*) as messages from bronze group by all"
    )
    sql["archived_days"] = with_bronze(
        f"""select {topic}, {parts}, event_type, count(*) as events,
 cast(coalesce(sum({big('diamond_count')}) filter (where event_type = 'gift'), 0) as bigint) as diamonds from bronze group by all"""
    )
    sql["nightly_slice"] = sql["silver_gifts"]
    sql["retention_cut"] = with_bronze(
        f"select * from t where event_timestamp >= {RETENTION_NOW} - interval 1 year", **live_gifts
    )
    problem = """case when not json_valid(value) then 'malformed_json'
 when try_cast(json_extract_string(case when json_valid(value) then value else '{}' end, '$.received_at') as timestamptz) is null then 'bad_timestamp' end"""
    sql["quarantine"] = with_input(
        inputs.LINES, "select value as raw, reason from p where reason is not null", p=f"select value, {problem} as reason from src"
    )
    sql["nightly_quarantine"] = sql["quarantine"]
    sql["nightly_run"] = with_bronze(
        f"""select {TABLE_OF} as item, category, streamer, {parts}, count(*) as n, min({TS}) as first_event from bronze
 where event_type in ({', '.join(f"'{k}'" for k in KINDS)})
 and not (event_type = 'gift' and substr(received_at, 1, 10) = '2024-01-06') group by all"""
    )
    sql["nightly_dry_run"] = with_bronze(
        """select '2024-01-05' as date, coalesce(event_type, 'total') as item, count(*) as rows from bronze
 where substr(received_at, 1, 10) = '2024-01-05' group by rollup (event_type)"""
    )
    sql["local_run"] = with_bronze(
        f"""select {TABLE_OF} as item, streamer, count(*) as n, max({TS}) as last_event from bronze
 where event_type in ('gift', 'comment', 'like', 'room_users') group by all"""
    )
    sql["registry_stream"] = sql["registry_state"]
    sql["archive_stream"] = with_bronze(
        f"select {topic}, {message(head)} as value, {parts}, strftime({TS}, '%H') as hour from bronze"
    )
    routed = {
        "p": f"select value, {problem} as reason from src",
        "env": """select json_extract_string(value, '$.streamer') as streamer, json_extract_string(value, '$.category') as category,
 cast(null as varchar) as archetype, json_extract_string(value, '$.event_type') as event_type,
 json_extract_string(value, '$.received_at') as received_at, json_extract(value, '$.data') as data from p where reason is null""",
    }
    sql["live_routing"] = with_input(
        inputs.LINES,
        f"""select map([{', '.join(f"'{k}'" for k in TABLES)}], [{', '.join(f"'{t}'" for t in TABLES.values())}])[event_type] as item,
 strftime({TS}, '%Y%m') as yyyymm, count(*) as n from env
 where event_type in ({', '.join(f"'{k}'" for k in TABLES)}) group by 1, 2
 union all select reason, null, count(*) from p where reason is not null group by 1""",
        **routed,
    )
    sql["live_stream_whales"] = with_input(
        inputs.LINES, whale("t", "unique_id"), **routed, t=typed_sql("gifts", "live", "env")
    )
    sql["registry_snapshot"] = sql["registry_state"]
    seeds = ", ".join(f"('{name}', '{category}', '{archetype}')" for name, category, archetype in SEEDS)
    sql["configured_registry"] = with_input(
        inputs.CONFIGURED,
        f"""select username, category, archetype, 'seed' as source, 'candidate' as status from (values {seeds}) s(username, category, archetype)
 union all select lower(ltrim(trim(name), '@')), category, 'general', 'config_seed', 'candidate' from src where ltrim(trim(name), '@') <> ''
 union all select 'added_by_hand', 'npc', 'general', 'cli_manual', 'candidate'""",
    )
    sql["catalog_tables"] = with_bronze(
        f"""select {TABLE_OF} as item, streamer, count(*) as n, max({TS}) as last_event from bronze
 where event_type in ({', '.join(f"'{k}'" for k in KINDS)}) group by all"""
    )
    sql["distinct_stream"] = with_input(
        inputs.LINES,
        f"""select map([{', '.join(f"'{k}'" for k in TABLES)}], [{', '.join(f"'{t}'" for t in TABLES.values())}])[event_type] as item,
 coalesce(streamer, '') as streamer, count(*) as n from env where event_type in ({', '.join(f"'{k}'" for k in TABLES)}) group by 1, 2""",
        p=f"select value, {problem} as reason from (select distinct value from src) d", env=routed["env"],
    )
    sql["quarantine_repaired"] = with_input(
        inputs.LINES,
        " union all ".join(
            f"select '{table}' as item, count(*) as n from r where json_extract_string(value, '$.event_type') = '{kind}'"
            for kind, table in TABLES.items()
        ) + " union all select reason, count(*) from p where reason = 'malformed_json' group by 1",
        p=f"select value, {problem} as reason from src",
        r="""select replace(value, '"received_at":"x', '"received_at":"') as value from p where reason is null or reason = 'bad_timestamp'""",
    )
    sql["live_view_whales"] = sql["live_stream_whales"]
    sql["live_view_streaks"] = with_input(inputs.LINES, streak("t"), **routed, t=typed_sql("gifts", "live", "env"))
    sql["live_view_verticals"] = with_input(
        inputs.LINES, vertical("t"), **routed, t=typed_sql("product_pins", "live", "env")
    )
    sql["live_retention"] = with_input(
        inputs.LINES,
        " union all ".join(
            f"""select '{table}' as item, streamer, cast(event_timestamp as date) as day, count(*) as n from t_{table}
 where event_timestamp >= timestamp '2024-01-15 12:00:00' group by all"""
            for table in TABLES.values()
        ),
        **routed, **{f"t_{table}": typed_sql(table, "live", "env") for table in TABLES.values()},
    )
    return sql
