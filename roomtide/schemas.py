"""The event envelope, the payload fields of each event type and the registry tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

ENVELOPE_COLUMNS = ("streamer", "category", "archetype", "event_type", "received_at", "data")
ENVELOPE = T.StructType([T.StructField(c, T.StringType()) for c in ENVELOPE_COLUMNS])

# Event type -> table.
TABLES = {
    "gift": "gifts",
    "comment": "comments",
    "like": "likes",
    "room_users": "room_viewers",
    "product_pin": "product_pins",
}
LOCAL_KINDS = ("like", "room_users", "gift", "comment")


@dataclass(frozen=True)
class Field:
    """One typed column of a payload.

    ``type``: text, count (non-negative integer), code (any integer), number or flag.
    ``legacy_key`` is a second key tried by the batch modes; ``absent`` is the text the batch modes
    assume for a missing key. The live mode uses the zero value of the type instead.
    """

    name: str
    key: str
    type: str
    legacy_key: str | None = None
    absent: str | None = None
    live_name: str | None = None
    live_only: bool = False


_USER_ID = Field("user_id", "user_id", "text")
_HANDLE = Field("user_handle", "unique_id", "text", legacy_key="user", live_name="unique_id")
_NICKNAME = Field("nickname", "nickname", "text")

PAYLOADS: dict[str, tuple[Field, ...]] = {
    "gift": (
        _USER_ID,
        _HANDLE,
        _NICKNAME,
        Field("gift_id", "gift_id", "count"),
        Field("gift_name", "gift_name", "text"),
        Field("diamond_count", "diamond_count", "count"),
        Field("repeat_count", "repeat_count", "count"),
        Field("is_streaking", "streaking", "flag", absent="false"),
        Field("is_repeat_end", "repeat_end", "flag", absent="false"),
        Field("usd_value", "usd_value", "number"),
    ),
    "comment": (
        _USER_ID,
        _HANDLE,
        _NICKNAME,
        Field("comment_text", "comment", "text"),
    ),
    "like": (
        _USER_ID,
        _HANDLE,
        Field("batch_count", "batch_count", "count"),
        Field("total_room_likes", "total_room_likes", "count"),
    ),
    "room_users": (
        Field("viewer_count", "viewer_count", "count"),
        Field("popularity", "popularity", "count", absent="0"),
    ),
    "product_pin": (
        Field("product_id", "product_id", "text"),
        Field("title", "title", "text"),
        Field("price", "price", "text"),
        Field("open_url", "open_url", "text"),
        Field("live_product_count", "live_product_count", "count"),
        Field("action_type", "action_type", "code", live_only=True),
    ),
}

# Sort keys of the live tables; the pins leave out the category.
LIVE_SORT = {
    table: (
        ("archetype", "streamer", "event_timestamp")
        if table == "product_pins"
        else ("category", "archetype", "streamer", "event_timestamp")
    )
    for table in TABLES.values()
}

REGISTRY_EVENTS = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("handle", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("archetype", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("viewers", T.LongType()),
        T.StructField("diamonds", T.LongType()),
        T.StructField("delay_sec", T.LongType()),
        T.StructField("reason", T.StringType()),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("username", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("archetype", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("discovered_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("cooldown_until", T.TimestampType()),
        T.StructField("blacklist_reason", T.StringType()),
        T.StructField("total_sessions", T.LongType()),
        T.StructField("peak_viewers", T.LongType()),
        T.StructField("total_diamonds_seen", T.LongType()),
        T.StructField("last_live", T.TimestampType()),
        T.StructField("last_checked", T.TimestampType()),
        T.StructField("first_seq", T.LongType()),
    ]
)

_USER = "struct<display_id:string,unique_id:string>"
BATTLES = (
    "seq bigint, ts timestamp, host string, "
    f"anchors array<struct<user:{_USER},anchor:{_USER},display_id:string,unique_id:string>>, "
    f"rival {_USER}"
)
