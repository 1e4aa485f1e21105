"""Defaults of the capture clients for users, gifts, comments, likes and rooms.

Two client variants exist. ``daemon`` is the multi-room capture service, ``local`` the one-room tool.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANONYMOUS = "anonymous"
VARIANTS = ("daemon", "local")


def filled(text: Column) -> Column:
    """Empty text as NULL."""
    return F.nullif(text, F.lit(""))


def normalize_handle(handle: Column) -> Column:
    """Trim, drop leading @ signs, lower-case; NULL if nothing is left."""
    trimmed = F.regexp_replace(handle, r"(?U)^\s+|\s+$", "")
    return filled(F.lower(F.regexp_replace(trimmed, "^@+", "")))


def _check(variant: str) -> None:
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, not {variant!r}")


def with_user_identity(users: DataFrame, variant: str = "daemon") -> DataFrame:
    """Add resolved_id, resolved_handle and resolved_nickname.

    Reads id, display_id, unique_id, nickname and, if there, user_id. An absent id stays NULL.
    """
    _check(variant)
    user_id = F.col("id").cast("string")
    named = (filled(F.col("display_id")), filled(F.col("unique_id")))
    nickname = F.col("nickname")
    if variant == "daemon":
        handle = F.coalesce(*named, nickname, F.lit(ANONYMOUS))
        shown = F.coalesce(nickname, F.lit(ANONYMOUS))
    else:
        handle = F.coalesce(*named, filled(nickname), user_id, F.lit(ANONYMOUS))
        shown = F.coalesce(filled(nickname), handle)
        if "user_id" in users.columns:
            user_id = F.coalesce(user_id, F.col("user_id").cast("string"))
    return users.withColumns(
        {"resolved_id": user_id, "resolved_handle": handle, "resolved_nickname": shown}
    )


def with_gift_defaults(gifts: DataFrame, variant: str = "daemon") -> DataFrame:
    """Add resolved_gift_id, resolved_name, resolved_diamonds and resolved_repeat.

    Reads event_gift_id, gift_id, gift_name, diamond_count and repeat_count.
    """
    _check(variant)
    event_id = F.col("event_gift_id").cast("string")
    name = F.col("gift_name")
    diamonds = F.coalesce(F.col("diamond_count"), F.lit(0)).cast("bigint")
    repeat = F.col("repeat_count").cast("bigint")
    if variant == "daemon":
        gift_id = event_id
        name = F.coalesce(name, F.lit("Unknown"))
        repeat = F.coalesce(F.nullif(repeat, F.lit(0)), F.lit(1))
    else:
        gift_id = F.coalesce(F.nullif(event_id, F.lit("0")), F.col("gift_id").cast("string"))
        name = F.coalesce(filled(name), F.concat(F.lit("Gift_"), F.coalesce(event_id, F.lit("unknown"))))
        repeat = F.coalesce(repeat, F.lit(1))
    return gifts.withColumns(
        {
            "resolved_gift_id": gift_id,
            "resolved_name": name,
            "resolved_diamonds": diamonds,
            "resolved_repeat": repeat.cast("bigint"),
        }
    )


def comment_text(comment: Column, content: Column) -> Column:
    return F.coalesce(filled(comment), content, F.lit(""))


def with_like_defaults(likes: DataFrame) -> DataFrame:
    """The daemon's like defaults: a batch of 1, a room total of 0."""
    return likes.withColumns(
        {
            "batch_count": F.coalesce("batch_count", F.lit(1)).cast("bigint"),
            "total_room_likes": F.coalesce("total_room_likes", F.lit(0)).cast("bigint"),
        }
    )


def with_room_defaults(rooms: DataFrame) -> DataFrame:
    return rooms.withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("viewer_count", "popularity")}
    )


def shown_pins(shopping: DataFrame, product: str = "pop_product") -> DataFrame:
    """Shopping events become pins only when a product is shown."""
    return shopping.where(F.col(product).isNotNull())
