"""States over micro-batches against the operators over the whole, for any split."""

import random

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from contract import inputs
from contract.inputs import bronze, spark_input, zoned
from roomtide.operators.sessions import carry_like_total, session_summary
from roomtide.streaming import states


def rows(df):
    def cell(v):
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    names = sorted(df.columns)
    return sorted(tuple(cell(r[n]) for n in names) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_session_totals_of_any_split(spark, tmp_path, seed):
    env, root = bronze(spark, SF_DIR).cache(), str(tmp_path)
    rng = random.Random(seed)
    part = F.pmod(F.xxhash64("received_at", "streamer", F.lit(seed)), F.lit(4))
    batches = [0, 1, 2, 3]
    rng.shuffle(batches)
    for number, chosen in enumerate(batches):
        for _ in range(1 + (number == 1)):  # the second one is replayed
            states.write_sessions(env.where(part == chosen), root, number)
        if number == 2:
            assert states.compact_sessions(spark, root, upto=1)
        seen = env.where(part.isin(batches[: number + 1]))
        assert rows(states.read_sessions(spark, root)) == rows(session_summary(seen)) != []
    assert states.read_sessions(spark, str(tmp_path / "none")).count() == 0


def test_like_totals_of_a_stretch_need_no_earlier_rows(spark, tmp_path):
    likes = zoned(spark_input(spark, SF_DIR, inputs.LIKES_WITH_GAPS), "event_timestamp").cache()
    root, tie = str(tmp_path), ("event_id",)
    whole = carry_like_total(likes, tie_break=tie)
    bucket = F.floor(F.unix_micros("event_timestamp") / F.lit(300 * 1_000_000))
    for number in range(3):
        states.write_likes(likes.where(F.col("event_id") % 3 == number), root, number, tie)
    states.compact_likes(likes, root, 1, tie)
    low, high = likes.agg(F.min(bucket), F.max(bucket)).first()
    cuts = [low, low + (high - low) // 3, low + (high - low) // 3 + 1, high + 1]
    for a, b in zip(cuts, cuts[1:]):
        stretch = likes.where(bucket.between(a, b - 1))
        got = states.carried_likes(stretch, root, a, b, tie)
        assert rows(got) == rows(whole.where(bucket.between(a, b - 1)))
