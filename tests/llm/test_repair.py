"""Cheapest repairs against plain dynamic programming and full search."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from roomtide.llm import repair

ARCS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
SCHEMA = "conv_id long, turn long, role string, text string, at string, AUDIT string"


def plain_repair(rows):
    """rows (role, text, gone, cut): cost, audit and lines, by carrying whole edit sequences for each state."""

    def inserted(ways):
        out = list(ways)
        for _ in range(2):
            ways = [
                (cost + 2, audit + "I", ARCS[state, letter], lines + (f"{name}:",))
                for cost, audit, state, lines in ways
                for letter, name in (("u", "user"), ("a", "assistant")) if (state, letter) in ARCS
            ]
            out += ways
        return out

    best = {0: (0, "", 0, ())}
    for role, text, gone, cut in rows:
        found = []
        for cost, audit, state, lines in inserted(best.values()):
            found.append((cost + 3, audit + "D", state, lines))
            if not gone:
                if (state, role[:1]) in ARCS:
                    found.append((cost + cut, audit + "K", ARCS[state, role[:1]], lines + (f"{role}:{text}",)))
                for name in ("user", "assistant"):
                    if (state, name[0]) in ARCS:
                        found.append((cost + 2 + cut, audit + "R", ARCS[state, name[0]], lines + (f"{name}:{text}",)))
        best = {}
        for way in sorted(found):
            best.setdefault(way[2], way)
    return min(w for w in inserted(best.values()) if w[2] in (0, 3))


def plain_report(conversations):
    kept, ids = collections.defaultdict(list), set()
    for conv, turn, role, text in conversations:
        ids.add(conv)
        role, text = (" " if role is None else role), (" " if text is None else text)
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        kept[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    for conv in ids:
        rows = sorted(kept[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults, judged = set(), collections.Counter(), []
        for _, role, text in rows:
            words = text.strip(" \t\n\v\f\r")
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {t for t, *_ in rows if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") or not a[1] or not b[1] for a, b in zip(rows, rows[1:]))
        cost, audit, _, lines = plain_repair(judged)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        yield conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest


def made(seed, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why? ", "cut off", "", " \t\n", None, "Same words here.", "é ñ ü.", "two\nlines.\n"]
    rows = [(None, None, None, None), (None, 3, "user", "A row."), (5, 2**40, "user", "Far.")]
    for conv in range(-3, 40):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "unknown"])
            rows.append((conv, rng.choice([turn, turn, turn + 7, None]), role, rng.choice(texts) if rng.random() < 0.6 else f"Text {turn}."))
    rows += [(900 + k, 0, "user", "Alone.") for k in range(40)]  # some lose their only row
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("run_rows,longest", [(8192, 12), (3, 30), (1, 9)])
def test_equals_plain_programming(spark, monkeypatch, run_rows, longest):
    monkeypatch.setattr(repair, "RUN_ROWS", run_rows)
    rows = made(run_rows, longest)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    got = sorted(map(tuple, repair.repair_report(df).collect()), key=str)
    assert got == sorted(plain_report(rows), key=str)


def test_least_of_all_edit_sequences():
    """Every sequence of edits up to two inserts before each row, for short conversations."""
    passes = repair.Remembered()
    for codes in map("".join, itertools.product("abcdefghijkl", repeat=2)):
        ways = []
        for edits in itertools.product([i + e for i in ("", "I", "II") for e in "DKR"], repeat=2):
            for tail in ("", "I", "II"):
                state, cost = 0, 2 * len(tail)
                for code, edit in [*zip(codes, edits), (None, tail)]:
                    kind, condition = ("o", 0) if code is None else (repair.CLASSES[repair.CODES.index(code) // 3], repair.CODES.index(code) % 3)
                    for letter in edit:
                        if letter == "D":
                            cost += 3
                            continue
                        role = kind if letter == "K" else repair.next_role(state)
                        cost += {"K": 0, "R": 2, "I": 2 * (code is not None)}[letter] + (condition == 1 and letter != "I")
                        state = ARCS.get((state, role)) if condition != 2 or letter == "I" else None
                        if state is None:
                            break
                    if state is None:
                        break
                if state in (0, 3):
                    ways.append((cost, "".join(edits) + tail))
        last, cost = repair.last_state(passes.forward(repair.start_at(0), codes))
        assert (cost, "".join(repair.solve(passes, codes, 0, last)) + repair.TAILS[last]) == min(ways)


def test_long_runs_and_their_summaries_agree():
    rng = random.Random(4)
    rows, items = repair.Remembered(), repair.Items()
    for _ in range(60):
        codes = "".join(rng.choice("abdeghjkcfil") for _ in range(rng.randrange(1, 400)))
        cost, audit, _, _ = plain_repair(
            [(repair.CLASSES[repair.CODES.index(c) // 3], "", repair.CODES.index(c) % 3 == 2, repair.CODES.index(c) % 3 == 1) for c in codes]
        )
        last, least = repair.last_state(rows.forward(repair.start_at(0), codes))
        assert (least, "".join(repair.solve(rows, codes, 0, last)) + repair.TAILS[last]) == (cost, audit)
        parts = [codes[i : i + 37] for i in range(0, len(codes), 37)]
        whole = []
        for part in parts:
            vectors = [rows.forward(repair.start_at(s), part) for s in repair.STATES]
            whole.append([[(v[0][e], v[1][e]) for e in repair.STATES] for v in vectors])
        last, least = repair.last_state(items.forward(repair.start_at(0), whole))
        ways = [0, *repair.crossings(items, whole, 0, last), last]
        joined = "".join("".join(repair.solve(rows, p, a, b)) for p, a, b in zip(parts, ways, ways[1:]))
        assert (least, joined + repair.TAILS[last]) == (cost, audit)


def test_lines_and_empty_tables(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Again."), (1, 2, "user", ""), (2, 0, "assistant", "Late.")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    lines = repair.Repair(df).lines().orderBy("conv_id", "number").collect()
    assert [(r.conv_id, r.line) for r in lines if r.conv_id == "1"] == [("1", "user:Hello."), ("1", "assistant:Again.")]
    assert [r.line for r in lines if r.conv_id == "2"] == ["user:", "assistant:Late."]
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair_report(none).count() == 0
