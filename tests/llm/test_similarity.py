"""Jaccard join, components, fingerprints, decontamination and sharding against brute force."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from roomtide.llm import decontamination, fingerprints, parity, sharding
from roomtide.llm.components import components
from roomtide.llm.jaccard import near_duplicate_classes, one_of_each_class

from llm_data import ODD, docs, prose  # noqa: F401


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def classes(rows, width, percent):
    """(doc_id, n, component) of every row by comparing all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = collections.defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(k)].append(doc_id)
    return [(i, len(sets[k]), min(least[find(k)], default=None)) for k, (i, _) in enumerate(rows)]


def family(rng, base, n, edits):
    words = base.split()
    for _ in range(n):
        copy = list(words)
        for _ in range(edits):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10_000)}"
        yield " ".join(copy)


def corpus(seed):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 120)) for _ in range(60)]
    for size, edits in ((40, 1), (100, 2), (200, 4), (300, 9), (60, 2), (12, 1)):
        texts += family(rng, prose(rng, size), 25, edits)
    texts += rng.choices(texts, k=25) + [t.upper() for t in texts[:5]]
    passage = prose(rng, 50)
    texts += [f"{prose(rng, 20)} {passage} {prose(rng, 20)}" for _ in range(30)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return ODD + list(zip((100 + o for o in order), texts))


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80), (1, 60)])
def test_classes_equal_all_pairs(docs, width, percent):
    rows = corpus(percent)
    got = near_duplicate_classes(docs(rows), width, percent).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, classes(rows, width, percent)))


def test_no_rows_no_classes(docs):
    assert near_duplicate_classes(docs([])).count() == 0
    assert sorted(near_duplicate_classes(docs([(1, None), (2, "")])).collect()) == [(1, 0, 1), (2, 0, 2)]


def test_one_of_each_class_stays(docs):
    rows = corpus(3)
    clashing = docs(rows).withColumns({"_id": F.lit(1), "_key": F.lit("k"), "component": F.lit(0)})
    kept = one_of_each_class(clashing)
    assert kept.columns == clashing.columns
    found = classes(rows, 5, 80)
    wordless = collections.Counter((i, t) for (i, t), (_, n, _) in zip(rows, found) if n == 0)
    first = {(c, ) if c is not None else t for (i, t), (_, n, c) in zip(rows, found) if n}
    got = kept.select("doc_id", "text").collect()
    assert len(got) == sum(wordless.values()) + len(first)
    by_component = {i: c for (i, _), (_, _, c) in zip(rows, found)}
    assert all(by_component[r.doc_id] == r.doc_id for r in got if r.doc_id is not None and shingles(r.text, 5))


def test_signatures_meet_whenever_sets_link():
    rng = np.random.default_rng(5)
    for percent in (60, 85):
        known = parity.bands(percent)
        for size in (3, 7, 8, 30, 100, 431, 2000):
            tokens = rng.integers(1, 2**63, size, dtype=np.uint64)
            for _ in range(20):
                extra = rng.integers(1, 2**63, size, dtype=np.uint64)
                for changed in range(0, size):
                    other = np.unique(np.concatenate([tokens[changed:], extra[: rng.integers(0, changed + 1)]]))
                    mine = np.unique(tokens)
                    common = len(np.intersect1d(mine, other))
                    if 100 * common < percent * (len(mine) + len(other) - common):
                        break
                    if len(np.setxor1d(mine, other)):
                        assert np.intersect1d(known.signatures(mine), known.signatures(other)).size
                    if size > 100:
                        break


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a = np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64))
        b = np.unique(rng.integers(0, 300, rng.integers(1, 3000)).astype(np.uint64))
        x, y = parity.dense_sketch(parity.mixed(a)), parity.dense_sketch(parity.mixed(b))
        words = min(len(x), len(y))
        assert np.bitwise_count(parity.folded(x, words) ^ parity.folded(y, words)).sum() <= len(np.setxor1d(a, b))


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + k, 1001 + k) for k in range(40)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for e in edges if e[0] is not None and e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints(docs):
    rng = random.Random(10)
    rows = [r for r in ODD if r[0] is not None] + [(10 + k, prose(rng, rng.randrange(1, 700))) for k in range(60)]
    rows += [(80, rows[20][1]), (90, rows[20][1] + " tail")]
    ordered = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    got = fingerprints.fingerprint_documents(docs(rows)).orderBy("doc_id", "n_chars", F.desc("near_next")).collect()
    assert len(got) == len(rows)
    for k, (doc_id, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1] or ""
        text, row = text or "", got[k]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        sets = [frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
                for w in (text.split(), edited.split(), following.split())]
        alike = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        assert (row.doc_id, row.n_chars) == (doc_id, len(text))
        assert abs(row.near_edited - alike[0]) < 0.2 and abs(row.near_next - alike[1]) < 0.2
        if len(sets[0] | sets[1]) <= fingerprints.K:
            assert row.near_edited == pytest.approx(alike[0])
        assert abs(row.shingles - len(sets[0])) <= 0.35 * len(sets[0])
    same = {r.fingerprint for r in got if r.doc_id in (80, rows[20][0])}
    assert len(same) == 1
    assert fingerprints.fingerprint_documents(docs([])).count() == 0
    (alone,) = fingerprints.fingerprint_documents(docs([(1, "a b c d e f g h")])).collect()
    assert alone.near_next == 1.0


def test_sketches_merge(spark):
    rng = random.Random(11)
    parts = [(k % 2, prose(rng, 400)) for k in range(6)]
    df = spark.createDataFrame(parts, "g int, text string").withColumn("sketch", fingerprints.sketch(F.col("text"), 64))
    merged = {r.g: r.sketch for r in fingerprints.merged(df, "g", k=64).collect()}
    for g in (0, 1):
        assert merged[g] == sorted({h for r in df.collect() if r.g == g for h in r.sketch})[:64]


def test_decontamination(docs, spark):
    rng = random.Random(12)
    items = [(k, prose(rng, n)) for k, n in enumerate((8, 15, 25, 40, 59))] + [(90, None), (91, ""), (92, "too short to tell"), (None, prose(rng, 30))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    clean = [(1000 + k, prose(rng, 150)) for k in range(40)]
    rows, leaks = ODD + clean, []
    for k, (item, text) in enumerate(items[:5] * 6):
        words = text.split()
        for _ in range(k // 5 * len(words) // 40):  # up to one word in eight
            words[rng.randrange(len(words))] = "swapped"
        leaks.append((2000 + k, item))
        rows = [*rows, (2000 + k, f"{prose(rng, 30)}, {' '.join(words).upper()}. {prose(rng, 30)}")]
    rows += [(3000, items[4][1]), (3001, " ".join(items[4][1].split()[:30]) + " " + prose(rng, 9)), (3001, clean[0][1]), (None, items[3][1])]
    leaks += [(3000, 4), (3001, 4), (None, 3)]
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs(rows), bench).collect()}
    assert found == set(leaks)
    kept = decontamination.without_benchmark(docs(rows), bench)
    assert kept.columns == docs(rows).columns
    assert kept.count() == len(rows) - len(leaks) and kept.filter("doc_id = 3001").count() == 1
    assert decontamination.without_benchmark(docs(rows), bench.limit(0)).count() == len(rows)
    assert decontamination.contaminated(docs([]), bench).count() == 0


def plain_matches(text, item):
    """Every alignment of an item with a text: is there a window (or the whole of a short item) with enough equal words?"""
    words, wanted = (re.findall(r"[^\W_]+", (t or "").lower()) for t in (text, item))
    width = min(20, len(wanted))
    for start in range(-len(wanted) + 1, len(words)) if wanted else ():
        equal = [0 <= start + k < len(words) and words[start + k] == w for k, w in enumerate(wanted)]
        if max(sum(equal[k : k + width]) for k in range(len(wanted) - width + 1)) >= (1 if len(wanted) < 7 else 0.8) * width:
            return True
    return False


def test_decontamination_equals_all_alignments(docs, spark):
    rng = random.Random(16)
    small = lambda n: " ".join(rng.choice("abcdefghijklmnop") + rng.choice("xyz") for _ in range(n))
    items = [(100 + n, small(n)) for n in range(1, 24)]
    items += [(7, small(9)), (7, small(12)), (None, small(15)), (None, small(8)), (300, None), (301, "?!"), (302, "")]
    rows = ODD + [(1000 + k, small(60)) for k in range(30)]
    for k in range(400):
        item = rng.choice(items)[1] or ""
        words = item.split()
        for at in rng.sample(range(len(words)), min(len(words), rng.choice([0, 1, 1, len(words) // 5, len(words) // 5 + 1]))):
            words[at] = "other"
        cut = rng.choice([0, 0, 0, len(words) // 4])
        rows.append((2000 + k, " ".join([small(rng.choice([0, 0, 9])), *words[cut:], small(rng.choice([0, 7]))])))
    bench = spark.createDataFrame([(*i, "x") for i in items + items[:3]], "item_id long, text string, HASHES string")
    got = decontamination.contaminated(docs(rows), bench).collect()
    expected = {(i, n, t) for i, t in rows for n, item in items if plain_matches(t, item)}
    texts = collections.defaultdict(set)
    for i, t in rows:
        texts[i].add(t)
    found = {(r.doc_id, r.item_id) for r in got}
    assert found == {(i, n) for i, n, _ in expected} and len(got) == len({(r.doc_id, r.text_key, r.item_id) for r in got})
    kept = decontamination.without_benchmark(docs(rows), bench)
    leaking = {(i, t) for i, _, t in expected}
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(str(r) for r in rows if r not in leaking)


def test_masks_lose_no_substitution_from_17_words_on():
    masks = decontamination.MASKS
    for count, swapped in ((17, 3), (18, 3), (19, 3), (20, 4)):
        for gone in itertools.combinations(range(count), swapped):
            laid = (at + k for m in masks for at in range(count - len(m) + 1) if not any(b == "1" and at + k in gone for k, b in enumerate(m)) for k in (0,))
            assert next(laid, None) is not None


def test_decontamination_without_broadcast(docs, spark, monkeypatch):
    rng = random.Random(13)
    bench = spark.createDataFrame([(1, prose(rng, 30))], "item_id long, text string")
    rows = [(1, prose(rng, 50)), (2, f"{prose(rng, 5)} {bench.first().text}")]
    monkeypatch.setattr(decontamination, "BROADCAST_SEEDS", 0)
    assert [r.doc_id for r in decontamination.contaminated(docs(rows), bench).collect()] == [2]


def test_differencing_beats_the_bound():
    rng = np.random.default_rng(14)
    for count in (0, 1, 3, 200):
        sizes = rng.integers(1, 10_000, count)
        vectors = np.zeros((count, 4), np.int64)
        vectors[:, -1] = sizes
        place, sums = sharding.difference(vectors)
        assert place.shape == (count, 4) and all(sorted(p) == [0, 1, 2, 3] for p in place.tolist())
        assert sorted(np.bincount(place[:, -1], sizes, 4).astype(int)) == sorted(sums.tolist())
    assert sums.max() - sums.min() < 20


def test_shards_are_even_however_many_parts(docs, spark, monkeypatch):
    rng = random.Random(17)
    sizes = [int(40 * rng.random() ** -1.2) for _ in range(900)]
    rows = [(k, "x" * min(n, 6000) + str(k)) for k, n in enumerate(sizes)] + [(2000 + k, "copy " * 30) for k in range(40)]
    df = docs(rows).cache()

    def spread(**more):
        totals = collections.Counter()
        for r in sharding.shard_rows(df, 8, **more).collect():
            totals[r.shard] += r.size
        return (max(totals.values()) - min(totals.values())) / (sum(totals.values()) / 8)

    whole = np.zeros((941, 8), np.int64)
    whole[:, -1] = [*(len(t) + 1 for _, t in rows[:900]), 151 * 40, *[0] * 40]
    _, plain = sharding.difference(whole[:901])
    assert spread() == pytest.approx((plain.max() - plain.min()) / plain.mean())
    for buckets in (2, 4, 30, 300):
        assert spread(buckets=buckets) < 0.002
    monkeypatch.setattr(sharding, "GROUPS_PER_BUCKET", 100)
    found = []
    for partitions in ("3", "17"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found.append(sorted(map(tuple, sharding.shard_rows(df, 8).collect())))
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_a_group_of_nearly_a_shard_is_made_up_for(docs):
    rng = random.Random(18)
    rows = [(k, "x" * rng.randrange(20, 60) + str(k)) for k in range(2000)] + [(5000, "y" * 11_000)]
    for buckets, most in ((1, 0.01), (10, 0.01), (40, 0.03)):  # 50 groups in each of 40 buckets leave more uneven
        totals = collections.Counter()
        for r in sharding.shard_rows(docs(rows), 8, buckets=buckets).collect():
            totals[r.shard] += r.size
        assert max(totals.values()) - min(totals.values()) < most * max(totals.values())


def test_shards(docs):
    rng = random.Random(15)
    rows = ODD + [(10 + k, prose(rng, rng.randrange(1, 60))) for k in range(400)] + [(500 + k, "copy of a text") for k in range(200)]
    got = sharding.shard_rows(docs(rows), 4).collect()
    assert len(got) == len(rows)
    slots, totals, places = collections.defaultdict(list), collections.Counter(), collections.defaultdict(set)
    texts = {i: t for i, t in rows if i not in (None, 3)}
    for r in got:
        slots[r.shard].append(r.slot)
        totals[r.shard] += r.size
        if r.doc_id in texts:
            assert r.size == len((texts[r.doc_id] or "").encode()) + 1
            places[texts[r.doc_id] or ""].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(p) == 1 for p in places.values())
    rest = [t for s, t in totals.items() if t < 30_000]
    assert max(rest) - min(rest) <= 200
    assert sharding.shard_rows(docs([])).count() == 0
