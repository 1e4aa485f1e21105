import pytest
from conftest import event, plan_of

from roomtide.operators import gold
from roomtide.operators.silver import typed


@pytest.fixture
def gifts(spark):
    columns = (
        "streamer string, category string, archetype string, user_handle string, gift_name string, "
        "diamond_count bigint, repeat_count bigint, is_streaking boolean, is_repeat_end boolean"
    )
    return lambda *rows: spark.createDataFrame(list(rows), columns)


def gift(user, diamonds, repeat=1, streaking=False, end=False, streamer="s", category="npc", name="g"):
    return (streamer, category, "a", user, name, diamonds, repeat, streaking, end)


def test_whale_share(gifts):
    df = gold.whale_analytics(gifts(
        gift("u1", 10, 3), gift("u1", 5), gift("u2", 65), gift("u3", 900, streaking=True),
        gift(None, 0), gift("u4", 9, category="ecommerce"), gift("u5", 7, streaking=None),
    ))
    row = df.collect()[0].asDict()
    assert row == {
        "streamer": "s", "archetype": "a", "total_unique_gifters": 2, "total_diamonds": 100,
        "top_whale_diamonds": 65, "top_whale_revenue_share_pct": 65.0,
    }


def test_share_of_nothing_is_null(gifts):
    assert gold.whale_analytics(gifts(gift("u1", 0))).first().top_whale_revenue_share_pct is None


def test_combo_end_and_final_are_different_filters(gifts):
    df = gifts(gift("u", 2, 5, streaking=True, end=True), gift("u", 2, 1, streaking=False, end=False))
    assert gold.streak_dynamics(df).first().total_diamonds_generated == 10
    assert gold.gift_revenue(df).first().total_diamonds == 2


def test_revenue_rounds_in_decimal(gifts):
    df = gold.gift_revenue(gifts(gift("u", 201), gift("u", 1, name="h")))
    assert {r.gift_name: r.approx_usd for r in df.collect()} == {"g": 1.01, "h": 0.01}
    assert gold.gift_revenue(gifts(gift("u", 200)), usd_rate=0.01).first().approx_usd == 2.0


def test_leaderboard_tie_at_the_edge(envelope):
    env = envelope(*[event("comment", f'{{"unique_id":"u{i}"}}') for i in (9, 3, 5, 1, 7, 2)])
    top = gold.top_commenters(typed(env, "comment"))
    assert [r.user_handle for r in top.collect()] == ["u1", "u2", "u3", "u5", "u7"]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_empty_tables_give_empty_reports(envelope):
    env = envelope()
    assert gold.top_likers(typed(env, "like")).count() == 0
    assert gold.viewer_metrics(typed(env, "room_users")).count() == 0
    assert gold.gift_revenue(typed(env, "gift")).count() == 0


def test_views_by_name(spark, gifts, envelope):
    env = envelope(event("product_pin", '{"product_id":"p"}', category="ecommerce"))
    names = gold.create_gold_views(spark, gifts(gift("u", 1, end=True)), typed(env, "product_pin"))
    assert [spark.table(n).count() for n in names] == [1, 1, 1]


@pytest.mark.parametrize("view", [gold.whale_analytics, gold.streak_dynamics, gold.gift_revenue])
def test_aggregates_combine_on_the_map_side_by_hashing(gifts, view):
    plan = plan_of(view(gifts(gift("u", 1))))
    assert "partial_sum" in plan and "SortAggregate" not in plan and "Python" not in plan
