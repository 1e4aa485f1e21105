import pytest
from pyspark.sql import functions as F

from roomtide.functions.identity import normalize_handle, with_gift_defaults, with_user_identity

USER = "id string, display_id string, unique_id string, nickname string"


@pytest.mark.parametrize(
    "variant, user, expected",
    [
        ("daemon", (None, None, None, None), (None, "anonymous", "anonymous")),
        ("daemon", ("1", "", "uu", "nn"), ("1", "uu", "nn")),
        ("daemon", ("1", "dd", "uu", "nn"), ("1", "dd", "nn")),
        ("daemon", ("1", None, "", "nn"), ("1", "nn", "nn")),
        ("local", (None, None, None, None), (None, "anonymous", "anonymous")),
        ("local", ("1", None, None, None), ("1", "1", "1")),
        ("local", ("1", "dd", None, ""), ("1", "dd", "dd")),
    ],
)
def test_user_identity(spark, variant, user, expected):
    row = with_user_identity(spark.createDataFrame([user], USER), variant).first()
    assert (row.resolved_id, row.resolved_handle, row.resolved_nickname) == expected


GIFT = "event_gift_id string, gift_id string, gift_name string, diamond_count int, repeat_count int"


@pytest.mark.parametrize(
    "variant, gift, expected",
    [
        ("daemon", ("5", "6", None, None, 0), ("5", "Unknown", 0, 1)),
        ("daemon", ("5", "6", "", 3, None), ("5", "", 3, 1)),
        ("local", ("5", "6", None, None, None), ("5", "Gift_5", 0, 1)),
        ("local", (None, "6", "", 3, 4), ("6", "Gift_unknown", 3, 4)),
        ("local", ("5", "6", "Rose", 3, 0), ("5", "Rose", 3, 0)),
    ],
)
def test_gift_defaults(spark, variant, gift, expected):
    row = with_gift_defaults(spark.createDataFrame([gift], GIFT), variant).first()
    assert (row.resolved_gift_id, row.resolved_name, row.resolved_diamonds, row.resolved_repeat) == expected


def test_unknown_variant(spark):
    with pytest.raises(ValueError):
        with_user_identity(spark.createDataFrame([(None,) * 4], USER), "other")


@pytest.mark.parametrize(
    "handle, expected",
    [(" @@Name ", "name"), ("@", None), ("  ", None), (None, None), ("a@B", "a@b"), (" @X\t", "x"), ("@ y", " y")],
)
def test_handles(spark, handle, expected):
    df = spark.createDataFrame([(handle,)], "h string")
    assert df.select(normalize_handle(F.col("h"))).first()[0] == expected
