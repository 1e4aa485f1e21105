from datetime import datetime

import pytest
from conftest import event, plan_of
from pyspark.sql import functions as F

from roomtide.functions.casts import event_time
from roomtide.functions.casts import to_bigint, to_flag
from roomtide.operators.silver import typed

GIFT = (
    '{"user_id":"7","unique_id":"ann","nickname":"Ann","gift_id":5,"gift_name":"Rose","diamond_count":2,'
    '"repeat_count":3,"repeat_end":true,"streaking":false,"usd_value":0.25}'
)


def one(df):
    return df.collect()[0].asDict()


def utc(df):
    return df.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


@pytest.mark.parametrize(
    "text, number",
    [("7", 7), (" 7 ", 7), ("5.7", 6), ("-5.5", -6), ("1e3", 1000), ("", None), ("x", None), (None, None),
     ("9007199254740993.0", 9007199254740993), ("1e30", None), ("NaN", None)],
)
def test_integer_text(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(to_bigint(F.col("t"))).first()[0] == number


@pytest.mark.parametrize(
    "text, flag",
    [("true", True), ("T", True), ("1", True), ("yes", True), ("y", True), ("0", False), ("no", False),
     ("n", False), ("false", False), ("on", None), ("off", None), ("", None), (None, None)],
)
def test_flag_text(spark, text, flag):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(to_flag(F.col("t"))).first()[0] is flag


def test_batch_keeps_microseconds_and_live_cuts_to_seconds(envelope):
    env = envelope(event("gift", GIFT))
    assert one(utc(typed(env, "gift")))["event_timestamp"] == datetime(2024, 1, 1, 0, 0, 0, 123456)
    assert one(utc(typed(env, "gift", "live")))["event_timestamp"] == datetime(2024, 1, 1)


def test_offset_counts(envelope):
    env = envelope(event("gift", GIFT, at="2024-01-01T07:00:00+07:00"))
    assert one(utc(typed(env, "gift")))["event_timestamp"] == datetime(2024, 1, 1)


def test_absent_values_stay_null_in_batch_and_are_zero_in_live(envelope):
    env = envelope(event("gift", "{}"))
    batch, live = one(typed(env, "gift")), one(typed(env, "gift", "live"))
    for name in ("user_id", "user_handle", "gift_id", "gift_name", "diamond_count", "repeat_count", "usd_value"):
        assert batch[name] is None
    assert batch["is_streaking"] is False and batch["is_repeat_end"] is False
    assert (live["user_id"], live["unique_id"], live["gift_name"]) == ("", "", "")
    assert (live["gift_id"], live["diamond_count"], live["usd_value"], live["is_streaking"]) == (0, 0, 0.0, False)


def test_json_null_reads_like_absent(envelope):
    env = envelope(event("gift", '{"user_id":null,"usd_value":null,"unique_id":null}'))
    assert one(typed(env, "gift"))["usd_value"] is None
    live = one(typed(env, "gift", "live"))
    assert (live["usd_value"], live["user_id"], live["unique_id"]) == (0.0, "", "")


def test_legacy_user_key_only_in_batch(envelope):
    env = envelope(event("like", '{"user":"old","batch_count":1}'))
    assert one(typed(env, "like"))["user_handle"] == "old"
    assert one(typed(env, "like", "local"))["user_handle"] == "old"
    assert one(typed(env, "like", "live"))["unique_id"] == ""


def test_live_text_must_be_a_json_string(envelope):
    env = envelope(event("product_pin", '{"product_id":17,"title":{"a":1},"price":"9.90","open_url":true}', category="ecommerce"))
    live = one(typed(env, "product_pin", "live"))
    assert (live["product_id"], live["title"], live["price"], live["open_url"]) == ("", "", "9.90", "")
    assert one(typed(env, "product_pin"))["product_id"] == "17"


def test_live_counts_are_not_negative_and_action_type_may_be(envelope):
    env = envelope(
        event("product_pin", '{"live_product_count":-4,"action_type":-2}'), event("product_pin", "{}"),
    )
    rows = [(r.live_product_count, r.action_type) for r in typed(env, "product_pin", "live").collect()]
    assert rows == [(0, -2), (0, 0)]
    assert "action_type" not in typed(env, "product_pin").columns


@pytest.mark.parametrize("mode", ["batch", "live"])
@pytest.mark.parametrize("archetype, expected", [("", "general"), (None, "general"), ("tech", "tech")])
def test_archetype_default(envelope, mode, archetype, expected):
    env = envelope(event("comment", "{}", archetype=archetype))
    assert one(typed(env, "comment", mode))["archetype"] == expected


def test_popularity_is_zero_when_absent(envelope):
    env = envelope(event("room_users", '{"viewer_count":"12"}'), event("room_users", '{"popularity":"x"}'))
    rows = [(r.viewer_count, r.popularity) for r in typed(env, "room_users").collect()]
    assert rows == [(12, 0), (None, None)]


def test_local_tables_have_no_taxonomy_and_no_pins(envelope):
    env = envelope(event("gift", GIFT))
    assert not {"category", "archetype"} & set(typed(env, "gift", "local").columns)
    with pytest.raises(ValueError):
        typed(env, "product_pin", "local")
    with pytest.raises(ValueError):
        typed(env, "gift", "other")


def test_unknown_types_and_broken_payloads(envelope):
    env = envelope(event("battle", "{}"), event("gift", '{"user_id":"1"'), event("gift", None))
    assert typed(env, "comment").count() == 0
    assert [r.user_id for r in typed(env, "gift").collect()] == [None, None]
    assert [r.user_id for r in typed(env, "gift", "live").collect()] == ["", ""]


def test_stored_columns_are_pruned_and_type_reaches_the_scan(spark, envelope, tmp_path):
    path = str(tmp_path / "env")
    envelope(event("gift", GIFT)).write.parquet(path)
    plan = plan_of(typed(spark.read.parquet(path), "room_users").select("viewer_count"))
    assert "EqualTo(event_type,room_users)" in plan
    assert "ReadSchema: struct<event_type:string,data:string>" in plan


def test_times_need_a_full_date_and_do_not_hang_on_the_session(spark):
    texts = ["12:30:00", "T01", "2024", "2024-01", "2024-01-05", "2024-01-05T06:07:08", "2024-01-05 06:07:08.5",
             "2024-01-05T06:07:08Z", "2024-01-05T06:07:08+02:00", "2024-01-05T06:07:08.25-0330", " 2024-01-05T06:07:08Z ", "soon", "", None]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [r[0] for r in df.select(F.unix_micros(event_time(F.col("t")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    day = 1704412800
    at = day + 6 * 3600 + 7 * 60 + 8
    seconds = [None if g is None else g / 1e6 for g in got]
    assert seconds[:9] == [None, None, None, None, day, at, at + 0.5, at, at - 7200]
    assert seconds[9] in (None, at + 0.25 + 3.5 * 3600) and seconds[10:] == [at, None, None, None]
