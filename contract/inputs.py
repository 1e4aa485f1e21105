"""Inputs derived from the driver's tables by SQL that reads the same in Spark and DuckDB.

Tokens: {T:name} a table, {ISO} the event time as ISO text, {K} the number in ``props``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.schemas import ENVELOPE_COLUMNS

SPARK_TOKENS = {
    "{ISO}": """concat(date_format(ts,"yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),'+00:00')""",
    "{K}": "cast(get_json_object(props,'$.k') as bigint)",
}
DUCK_TOKENS = {
    "{ISO}": "concat(strftime(ts,'%Y-%m-%dT%H:%M:%S.%f'),'+00:00')",
    "{K}": "cast(json_extract_string(props,'$.k') as bigint)",
}

# purchase -> gift, click -> like, view -> room_users, signup -> comment, error -> product_pin for
# shops and an unknown type for the others.
BRONZE = """
with b as (select *, user_id % 12 as sno, event_id % 61 as vno, {K} as k from {T:events}),
e as (select *, case when sno % 3 < 2 then 'npc' else 'ecommerce' end as category from b)
select event_id, concat('s', cast(sno as string)) as streamer, category,
 case when sno % 5 = 0 then '' when sno % 5 = 1 then null
      when category = 'npc' then 'pure_robotic' else 'beauty' end as archetype,
 case event_type when 'purchase' then 'gift' when 'click' then 'like' when 'view' then 'room_users'
      when 'signup' then 'comment'
      else case when category = 'ecommerce' then 'product_pin' else 'battle' end end as event_type,
 {ISO} as received_at,
 case event_type
  when 'purchase' then concat('{"user_id":"', cast(vno as string), '","',
    case when vno % 10 = 0 then 'user' else 'unique_id' end, '":"u', cast(vno as string),
    '","nickname":"n', cast(vno as string), '","gift_id":', cast(k % 10 as string),
    ',"gift_name":"g', cast(k % 10 as string), '","diamond_count":', cast(1 + k % 50 as string),
    ',"repeat_count":', cast(1 + event_id % 9 as string),
    ',"repeat_end":', case when event_id % 3 = 1 then 'true' else 'false' end,
    ',"streaking":', case when event_id % 3 = 0 then 'true' else 'false' end,
    ',"usd_value":', case when event_id % 4 = 0 then 'null' else concat(cast(k as string), '.25') end, '}')
  when 'click' then concat('{"user_id":"', cast(vno as string), '","unique_id":"u', cast(vno as string),
    '","batch_count":', cast(1 + k % 15 as string), ',"total_room_likes":', cast(event_id * 3 as string), '}')
  when 'view' then concat('{"viewer_count":', cast(k as string),
    case when event_id % 2 = 0 then '' else concat(',"popularity":', cast(k * 10 as string)) end, '}')
  when 'signup' then concat('{"user_id":"', cast(vno as string), '","unique_id":"u', cast(vno as string),
    '","nickname":"n', cast(vno as string), '","comment":"c', cast(k as string), '"}')
  else concat('{"product_id":', case when event_id % 7 = 0 then 'null' else concat('"p', cast(k % 20 as string), '"') end,
    ',"title":"t', cast(k % 20 as string), '","price":"9.99","open_url":"http://x/', cast(k % 20 as string),
    '","live_product_count":', cast(k % 30 as string), '}')
 end as data
from e
"""

# Gift rows as the typed table has them, from the largest table.
GIFT_FACTS = """
select l_shipdate as event_timestamp, concat('s', cast(l_suppkey as string)) as streamer,
 case when l_suppkey % 3 < 2 then 'npc' else 'ecommerce' end as category,
 case when l_suppkey % 2 = 0 then 'pure_robotic' else 'pk_battler' end as archetype,
 concat('u', cast(l_partkey % 5000 as string)) as user_handle,
 concat('g', cast(l_linenumber as string)) as gift_name,
 cast(l_quantity as bigint) as diamond_count, 1 + l_orderkey % 9 as repeat_count,
 l_returnflag = 'N' as is_streaking, l_linestatus = 'F' as is_repeat_end
from {T:lineitem}
"""

REGISTRY_LOG = """
select event_id as seq, ts, concat('h', cast(user_id as string)) as handle,
 case event_type when 'signup' then 'add' when 'view' then 'offline' when 'purchase' then 'probation'
      when 'click' then 'stream_end'
      else case when event_id % 50 = 0 then 'invalid' else 'offline' end end as op,
 case when user_id % 3 < 2 then 'npc' else 'ecommerce' end as category,
 case when event_id % 3 = 0 then 'general' when event_id % 3 = 1 then 'beauty' else 'tech' end as archetype,
 concat('src', cast(event_id % 7 as string)) as source,
 event_id % 2 = 0 as passed, event_id % 97 as viewers, event_id % 1009 as diamonds,
 case when event_type = 'error' then 300 else 180 end as delay_sec,
 concat('why', cast(event_id % 11 as string)) as reason
from {T:events}
"""

BATTLES = """
select event_id, ts, concat('s', cast(user_id % 12 as string)) as host,
 concat('S', cast(event_id % 15 as string)) as anchor1, concat('S', cast(user_id % 12 as string)) as anchor2,
 concat('New', cast(event_id % 30 as string)) as anchor3,
 case when event_id % 2 = 0 then null else concat('x', cast(event_id % 7 as string)) end as rival
from {T:events} where event_type = 'error'
"""

# Battles whose opponents become hosts in their turn; New0 meets New1, who meets New2, and so on.
CHAIN_BATTLES = """
select event_id, ts,
 case when event_id % 3 = 0 then concat('s', cast(user_id % 12 as string))
      when event_id % 3 = 1 then concat('New', cast(event_id % 10 as string))
      else concat('x', cast(event_id % 7 as string)) end as host,
 concat('S', cast(event_id % 15 as string)) as anchor1, concat('S', cast(user_id % 12 as string)) as anchor2,
 case when event_id % 3 = 1 then concat('New', cast(event_id % 10 + 1 as string)) else 'New0' end as anchor3,
 case when event_id % 2 = 0 then null else concat('x', cast(event_id % 7 as string)) end as rival
from {T:events} where event_type = 'error'
"""

CREATORS = """
select distinct concat('s', cast(user_id % 12 as string)) as username,
 case when user_id % 12 % 3 < 2 then 'npc' else 'ecommerce' end as category,
 case when user_id % 12 % 5 < 2 then 'general' when user_id % 12 % 3 < 2 then 'pure_robotic' else 'beauty' end as archetype
from {T:events}
"""

CONFIGURED = """
select concat('n', cast(c_nationkey as string)) as category, c_custkey % 50 as document,
 concat(case when c_custkey % 3 = 0 then ' @' else '' end,
  case when c_custkey % 11 = 0 then '' else concat('Shop', cast(c_custkey as string)) end) as name
from {T:customer}
"""

RAW_USERS = """
select c_custkey, case when c_custkey % 11 = 0 then null else c_custkey end as id,
 case when c_custkey % 2 = 0 then null else concat('d', cast(c_custkey as string)) end as display_id,
 case when c_custkey % 3 = 0 then '' else concat('u', cast(c_custkey as string)) end as unique_id,
 case when c_custkey % 5 = 0 then null when c_custkey % 7 = 0 then '' else c_name end as nickname,
 c_custkey + 5 as user_id
from {T:customer}
"""

RAW_HANDLES = """
select c_custkey, case c_custkey % 5 when 0 then '   ' when 1 then concat(' @@', c_name, ' ')
 when 2 then '@' when 3 then upper(c_name) else concat('a@', c_mktsegment) end as handle
from {T:customer}
"""

RAW_GIFTS = """
select l_orderkey, l_linenumber,
 case when l_partkey % 7 = 0 then null when l_partkey % 7 = 1 then 0 else l_partkey end as event_gift_id,
 l_suppkey as gift_id,
 case when l_linenumber % 3 = 0 then null when l_linenumber % 3 = 1 then ''
      else concat('g', cast(l_linenumber as string)) end as gift_name,
 case when l_orderkey % 4 = 0 then null else cast(l_quantity as bigint) end as diamond_count,
 case when l_orderkey % 5 = 0 then null when l_orderkey % 5 = 1 then 0 else l_orderkey % 9 end as repeat_count
from {T:lineitem}
"""

RAW_ROOM = """
select event_id, event_type,
 case when event_id % 3 = 0 then null when event_id % 3 = 1 then '' else concat('c', cast({K} as string)) end as comment,
 case when event_id % 2 = 0 then null else concat('d', cast({K} as string)) end as content,
 case when event_id % 4 = 0 then null else {K} end as batch_count,
 case when event_id % 5 = 0 then null else event_id end as total_room_likes,
 case when event_id % 6 = 0 then null else {K} end as viewer_count,
 case when event_id % 7 = 0 then null else {K} * 10 end as popularity,
 case when event_id % 8 = 0 then null else concat('p', cast({K} as string)) end as pop_product
from {T:events}
"""

LIKES_WITH_GAPS = """
select event_id, ts as event_timestamp, concat('s', cast(user_id % 12 as string)) as streamer,
 case when event_id % 3 = 0 then event_id * 3 else null end as total_room_likes
from {T:events}
"""

CHECKS = """
select event_id as seq, ts, concat('h', cast(user_id as string)) as username, event_type in ('click', 'view') as is_live,
 case when event_type <> 'error' then null
      when event_id % 4 = 0 then 'User is NOT CAPABLE of going live' when event_id % 4 = 1 then 'account does not exist'
      when event_id % 4 = 2 then 'USER_NOT_FOUND: x' else 'timeout' end as error
from {T:events}
"""

# Texts that are hard to read as number, flag or time.
CAST_EDGES = """
select event_id,
 case event_id % 8 when 0 then '5.7' when 1 then '1e3' when 2 then '' when 3 then '-5.5' when 4 then 'abc'
  when 5 then ' 12 ' when 6 then null else cast(event_id as string) end as number_text,
 case event_id % 7 when 0 then 'yes' when 1 then 'on' when 2 then 'TRUE' when 3 then '0' when 4 then ''
  when 5 then null else 'n' end as flag_text,
 case event_id % 6 when 0 then '2024-01-05T06:07:08+02:00' when 1 then '12:30:00' when 2 then '2024'
  when 3 then '2024-01-05' when 4 then '2024-01-05T06:07:08.5' else 'soon' end as time_text
from {T:events}
"""

# Message lines, some cut short and some with an unreadable time.
LINES = """
with m as (select event_id, concat('{"streamer":"', streamer, '","category":"', category, '","event_type":"', event_type,
  '","received_at":"', received_at, '","data":', data, '}') as value from ({BRONZE}) q)
select event_id, case when event_id % 17 = 0 then substr(value, 1, 40)
  when event_id % 19 = 0 then replace(value, '"received_at":"', '"received_at":"x') else value end as value
from m
"""


def expand(sql: str, tokens: dict[str, str], table) -> str:
    sql = sql.replace("{BRONZE}", BRONZE)
    for token, text in tokens.items():
        sql = sql.replace(token, text)
    return re.sub(r"\{T:(\w+)\}", lambda m: table(m.group(1)), sql)


def duck(sql: str) -> str:
    return expand(sql, DUCK_TOKENS, lambda name: name).strip()


def spark_input(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The derivation over the tables of ``sf_dir``."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(name: str) -> str:
        view = f"contract_{name}"
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(view)
        return view

    return spark.sql(expand(sql, SPARK_TOKENS, table))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_input(spark, sf_dir, BRONZE).select(*ENVELOPE_COLUMNS)


def zoned(df: DataFrame, *columns: str) -> DataFrame:
    """The tables' zoneless times as instants."""
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def battles(spark: SparkSession, sf_dir: str, sql: str = BATTLES) -> DataFrame:
    """Battles in nested form, each anchor naming its creator in another of the three places."""
    def user(display, unique):
        return F.struct(
            F.lit(display).cast("string").alias("display_id"), F.lit(unique).cast("string").alias("unique_id")
        )

    nobody = F.lit(None).cast("struct<display_id:string,unique_id:string>")

    def anchor(as_user, as_anchor, display=None, unique=None):
        return F.struct(
            as_user.alias("user"), as_anchor.alias("anchor"),
            F.lit(display).cast("string").alias("display_id"), F.lit(unique).cast("string").alias("unique_id"),
        )

    flat = zoned(spark_input(spark, sf_dir, sql), "ts")
    return flat.select(
        F.col("event_id").alias("seq"),
        "ts",
        "host",
        F.array(
            anchor(user(F.col("anchor1"), None), nobody),
            anchor(nobody, user("", F.col("anchor2"))),
            anchor(nobody, nobody, F.col("anchor3")),
        ).alias("anchors"),
        F.when(F.col("rival").isNotNull(), user(None, F.col("rival"))).alias("rival"),
    )
