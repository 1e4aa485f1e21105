"""The trie of conversation prefixes against a plain one."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from roomtide.llm import prefix_trie, turns

SCHEMA = "conv_id long, turn long, role string, text string, position string, ID string, length string"


def plain_conversations(rows):
    found = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(role, text) for *_, role, text in sorted(said)] for c, said in found.items()}


def rebuilt(said):
    out = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = said.get(donor, [])[:h] + said[c][h:]
    return out


def plain_trie(said):
    members = collections.defaultdict(list)
    for c, way in said.items():
        for d in range(len(way) + 1):
            members[tuple(way[:d])].append(c)
    children = collections.Counter(way[:-1] for way in members if way)
    leaves, saved = collections.Counter(), collections.Counter()
    for way, held in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", way[-1][1])) if way else 0
        for d in range(len(way) + 1):
            leaves[way[:d]] += not children[way]
            saved[way[:d]] += (len(held) - 1) * words
    for way, held in members.items():
        ends = ",".join(map(str, sorted(c for c in held if len(said[c]) == len(way))))
        parent = min(members[way[:-1]]) if way else None
        yield (min(held), len(way), parent, len(held), children[way], leaves[way], saved[way], hashlib.sha256(ends.encode()).hexdigest())


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def made(seed):
    rng = random.Random(seed)
    rows = [(None, 1, "user", "no conversation"), (7, None, None, None), (7, None, "user", "no turn"), (7, 3, "user", ""), (7, 3, "user", "")]
    stem = [("user" if k % 2 == 0 else "assistant", f"word {k} " * (k % 4)) for k in range(40)]
    for conv in [*range(-25, 60), 10_000, 10_001, 10_020]:
        if rng.random() < 0.2 or conv == 7:
            continue
        shared = rng.choice([0, 1, 2, 5, 8, 9, 16, 17, 30, 40])
        for k, (role, text) in enumerate(stem[:shared]):
            rows.append((conv, k, role, text))
        for k in range(rng.randrange(0, 4) + (shared == 0)):
            rows.append((conv, shared + k, rng.choice(["user", None, "assistant"]), rng.choice(["a", "b c", None, "d\te\vf"])))
    rng.shuffle(rows)
    return rows


def same(df, expected):
    assert sorted(map(tuple, df.collect()), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("run,chunk", [(4096, 4096), (1, 3)])
def test_equals_a_plain_trie(spark, monkeypatch, run, chunk):
    monkeypatch.setattr(turns, "RUN", run)
    monkeypatch.setattr(prefix_trie, "IDS_PER_CHUNK", chunk)
    rows = made(run)
    df = conversations(spark, rows).repartition(5)
    same(prefix_trie.shared_opening_trie(df), plain_trie(rebuilt(plain_conversations(rows))))
    same(prefix_trie.conversation_trie(df), plain_trie(plain_conversations(rows)))


def test_chains_that_hang_deep(spark):
    # Conversation k leaves conversation k - 1 at its last turn, so chains hang on chains 20 deep.
    rows = [(k, t, "user", f"{t}" if t < k else f"{t}.{k}") for k in range(21) for t in range(k + 2)]
    same(prefix_trie.conversation_trie(conversations(spark, rows)), plain_trie(plain_conversations(rows)))


def test_conversations_that_lose_all_turns_and_none_at_all(spark):
    rows = [(c, 0, "user", "only") for c in range(1, 19)]  # no donor: those with a shared turn have none left
    df = prefix_trie.shared_opening_trie(conversations(spark, rows))
    same(df, plain_trie(rebuilt(plain_conversations(rows))))
    assert prefix_trie.shared_opening_trie(conversations(spark, [])).count() == 0
    assert prefix_trie.conversation_trie(conversations(spark, [(None, 1, "user", "x")])).count() == 0


def test_positions_of_one_conversation_over_many_partitions(spark):
    rows = [(c, t, "user", "same") for c in (1, None) for t in [None, None, *range(500), 5, 5]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = turns.numbered(df, ["role", "text"], "turns_test").collect()
    for c in (1, None):
        mine = sorted((r.position, r.turn) for r in got if r.conv_id == c)
        assert [p for p, _ in mine] == list(range(1, 505))
        assert [t for _, t in mine] == sorted([r[1] for r in rows if r[0] == c], key=lambda t: (t is not None, t))
