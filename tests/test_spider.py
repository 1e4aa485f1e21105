import random

import pytest

from roomtide.operators.registry import fold_registry
from roomtide.operators.spider import battle_opponents, discover, discover_reach, discovery_events, meeting_events
from roomtide.schemas import BATTLES

POOL = "username string, category string, archetype string"


@pytest.fixture
def battles(spark):
    def user(name):
        return {"display_id": name, "unique_id": None}

    def make(*rows):
        """(seq, host, [opponents], rival)"""
        full = [
            (seq, None, host, [{"user": user(o), "anchor": None, "display_id": None, "unique_id": None} for o in others],
             user(rival) if rival else None)
            for seq, host, others, rival in rows
        ]
        return spark.createDataFrame(full, BATTLES)

    return make


@pytest.fixture
def pool(spark):
    return lambda *rows: spark.createDataFrame(list(rows), POOL)


def test_opponent_handles(spark):
    user = lambda d, u: {"display_id": d, "unique_id": u}
    anchors = [
        {"user": user("Ann", "x"), "anchor": user("no", None), "display_id": "no", "unique_id": None},
        {"user": None, "anchor": user("", "Bob"), "display_id": "no", "unique_id": None},
        {"user": None, "anchor": None, "display_id": None, "unique_id": "CAT"},
        {"user": user(None, ""), "anchor": None, "display_id": None, "unique_id": None},
        {"user": user("HOST", None), "anchor": None, "display_id": None, "unique_id": None},
    ]
    df = spark.createDataFrame([(1, None, "Host", anchors, user(None, "ann")), (2, None, "h", None, None)], BATTLES)
    assert sorted((r.host, r.opponent) for r in battle_opponents(df).collect()) == [
        ("host", "ann"), ("host", "bob"), ("host", "cat"),
    ]


def test_first_discovery_wins_and_known_creators_stay(battles, pool):
    found = discover(
        battles((5, "shop", ["new", "n"], None), (3, "n", ["New", "shop"], "third"), (1, "stranger", ["new"], None)),
        pool(("n", "npc", "pure_robotic"), ("shop", "ecommerce", "beauty")),
    )
    rows = {r.username: (r.category, r.archetype, r.source, r.seq) for r in found.collect()}
    assert rows == {
        "new": ("npc", "pk_battler", "pk_battle_@n", 3), "third": ("npc", "pk_battler", "pk_battle_@n", 3),
    }
    state = {r.username: (r.archetype, r.source) for r in fold_registry(discovery_events(found)).collect()}
    assert state["new"] == ("pk_battler", "pk_battle_@n")


def test_shops_pass_on_their_archetype(battles, pool):
    found = discover(battles((1, "shop", ["new"], None)), pool(("shop", "ecommerce", "beauty")))
    assert (found.first().category, found.first().archetype) == ("ecommerce", "beauty")


def test_reach_against_a_plain_walk(battles, pool):
    rng = random.Random(8)
    rows = [(i, f"c{rng.randrange(60)}", [f"c{rng.randrange(60)}" for _ in range(2)], None) for i in range(45)]
    rows += [(100 + i, "c0", [f"c{i % 7}"], None) for i in range(60)]
    neighbours = {}
    for _, host, others, _ in rows:
        neighbours.setdefault(host, set()).update(set(others) - {host})
    hops, frontier = {"c0": 0}, {"c0"}
    for hop in range(1, 20):
        frontier = {o for h in frontier for o in neighbours.get(h, ()) if o not in hops}
        hops.update(dict.fromkeys(frontier, hop))
    assert max(hops.values()) > 2
    for limit in (1, 2, None):
        got = discover_reach(battles(*rows), pool(("c0", "npc", "general")), max_hops=limit)
        assert {r.username: r.hop for r in got.collect()} == {u: h for u, h in hops.items() if limit is None or h <= limit}


def test_reach_ends_only_when_nobody_new_is_met(battles, pool):
    got = discover_reach(battles(*[(i, f"c{i}", [f"c{i + 1}"], None) for i in range(7)]), pool(("c0", "npc", "general")))
    assert {r.username: r.hop for r in got.collect()} == {f"c{i}": i for i in range(8)}


def test_archetypes_are_upgraded(battles, pool):
    creators = pool(("shop", "ecommerce", "general"), ("n", "npc", "general"), ("old", "ecommerce", "general"), ("set", "npc", "dance"))
    fights = battles((1, "shop", ["peer"], None), (2, "n", ["peer", "old", "set"], None))
    (found,) = discover(fights, creators).collect()
    assert (found.username, found.category, found.archetype, found.source) == ("peer", "ecommerce", "pk_battler", "pk_battle_@shop")
    added = discovery_events(creators.selectExpr("*", "'seed' as source", "-1L as seq"))
    state = fold_registry(added.unionByName(meeting_events(fights, creators)))
    assert {r.username: (r.category, r.archetype, r.source) for r in state.collect()} == {
        "shop": ("ecommerce", "general", "seed"), "n": ("npc", "general", "seed"), "set": ("npc", "dance", "seed"),
        "old": ("ecommerce", "pk_battler", "seed"), "peer": ("ecommerce", "pk_battler", "pk_battle_@shop"),
    }
