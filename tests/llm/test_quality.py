"""The line field against sums over all labellings, numeric slopes and held-out documents."""

import itertools
import random
import zlib

import numpy as np
import pytest

from roomtide.llm import quality

from llm_data import ODD, docs, prose  # noqa: F401


def random_field(seed, scale=0.5):
    return quality.Field(np.random.default_rng(seed).normal(0, scale, quality.FEATURES + 6))


def joint(field, features, labels):
    """Unnormalised probability of one text's labels, factor by factor."""
    start, pairs = field.w[quality.FEATURES :][:2], field.w[quality.FEATURES + 2 :].reshape(2, 2)
    total = start[labels[0]] + sum(pairs[a, b] for a, b in zip(labels, labels[1:]))
    for one, label in zip(features, labels):
        total += (label - 0.5) * sum(field.emission[f] for f in one)
    return np.exp(total)


TEXTS = ["One line.", None, "", "a\n\nb c d!!\nA B C\n12 34", "x\n" * 6, "Same.\nSame.\nOther | line | here", "é ñ ü\n\U0001f600 ok ok ok ok"]


def test_marginals_are_sums_over_all_labellings():
    field = random_field(1, 0.2)
    features, weights, sizes = quality.described(TEXTS)
    both, starts, crossed = field.chain(features, sizes)
    at, all_starts, all_pairs = 0, np.zeros(2), np.zeros((2, 2))
    for text, size in zip(TEXTS, sizes):
        assert size == (text or "").count("\n") + 1
        own = features[at : at + size]
        ways = {labels: joint(field, own, labels) for labels in itertools.product((0, 1), repeat=size)}
        total = sum(ways.values())
        for k in range(size):
            assert both[at + k, 1] == pytest.approx(sum(p for way, p in ways.items() if way[k]) / total)
        for way, p in ways.items():
            all_starts[way[0]] += p / total
            for a, b in zip(way, way[1:]):
                all_pairs[a, b] += p / total
        at += size
    assert starts == pytest.approx(all_starts) and crossed == pytest.approx(all_pairs)
    scores = quality.qualities(field, TEXTS)
    first = both[1 + 1 + 1 :][:5, 1]
    assert scores[3] == pytest.approx((first * [2, 1, 8, 6, 6]).sum() / 23)
    assert scores[1] == scores[2]


def test_slope_of_the_likelihood():
    field = random_field(2, 0.2)
    features, _, sizes = quality.described(TEXTS)
    labels = np.random.default_rng(3).integers(0, 2, len(features))

    def likelihood(weights):
        total, at, one = 0.0, 0, quality.Field(weights)
        for size in sizes:
            own, said = features[at : at + size], tuple(labels[at : at + size])
            total += np.log(joint(one, own, said) / sum(joint(one, own, w) for w in itertools.product((0, 1), repeat=size)))
            at += size
        return total

    slope = field.gradient(features, sizes, labels)
    used = [*np.unique(features)[::9], *range(quality.FEATURES, quality.FEATURES + 6)]
    for k in used:
        step = np.zeros_like(field.w)
        step[k] = 1e-5
        assert slope[k] == pytest.approx((likelihood(field.w + step) - likelihood(field.w - step)) / 2e-5, abs=1e-4)


def test_pieces_do_not_change_measures(monkeypatch):
    rng = random.Random(5)
    texts = [*TEXTS, *("\n".join(prose(rng, rng.randrange(0, 9)) for _ in range(rng.randrange(1, 30))) for _ in range(40))]
    whole, scores = quality.described(texts), quality.qualities(random_field(6, 0.1), texts)
    monkeypatch.setattr(quality, "CHARS_AT_ONCE", 50)
    for a, b in zip(whole, quality.described(texts)):
        assert (a == b).all()
    assert quality.qualities(random_field(6, 0.1), texts) == pytest.approx(scores)


def test_measures_of_a_line():
    features, weights, sizes = quality.described(["Ab ab ab!! 9 |\nAb"])
    counts, share = (lambda n: np.digitize(n, quality.COUNTS)), (lambda x: np.digitize(x, quality.SHARES))
    own = features[0, : quality.MEASURES] - np.arange(quality.MEASURES) * quality.BINS
    assert own[:12].tolist() == [
        counts(14), counts(5), np.digitize(10 / 5, quality.LENGTHS), share(6 / 10), share(1 / 6), share(1 / 10), share(1 / 10),
        share(2 / 10), share(1 / 10), share(5 / 5), share(0), share(2 / 5),
    ]
    assert own[12:].tolist() == [quality.UPPER, quality.SYMBOL, counts(1), counts(2), 0]
    assert weights.tolist() == [15, 3] and sizes.tolist() == [2]
    assert quality.described(["a a b a a"])[0][0, 9] - 9 * quality.BINS == share(2 / 5)
    assert quality.described(["a a b a a"])[0][0, 10] - 10 * quality.BINS == share(2 / 5)


def labelled(seed, n=700):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(10, n):
        lines = [prose(rng, rng.randrange(5, 25)).capitalize() + "." for _ in range(rng.randrange(1, 8))]
        bad = rng.random() < 0.25
        if bad:
            keep = rng.randrange(0, 2)
            lines[keep:] = [" | ".join([w] * rng.randrange(5, 20)) for w in prose(rng, rng.randrange(3, 8)).split()]
        rows.append((k, "\n".join(lines)))
        labels.append((k, int(not bad)))
    return rows, labels


def test_held_out_documents(docs, spark):
    rows, labels = labelled(7)
    more = [(None, 1), (9999, None), (10, 1 - labels[0][1]), (10, labels[0][1])]
    table = spark.createDataFrame([(*r, "x") for r in labels + more], "doc_id long, quality int, SCORE string")
    got = quality.score_documents(docs(rows + ODD), table).collect()
    assert len(got) == len(rows) + len(ODD)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert len(held) > 80 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    again = quality.score_documents(docs(rows + ODD).repartition(3), spark.createDataFrame(
        [(*r, "x") for r in flipped + more[:2] + [(10, 1 - flipped[0][1])]], "doc_id long, quality int, SCORE string"
    )).collect()
    key = lambda r: (str(r.doc_id), round(r.score, 9))
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_without_labels_documents_or_room(docs, spark):
    rows, labels = labelled(8, 60)
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    none = quality.score_documents(docs(rows), table.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert quality.score_documents(docs([]), table).count() == 0
    assert quality.fit(docs(rows), table, max_lines=0) == []
    assert quality.fit(docs(rows), table, max_examples=20) == quality.fit(docs(rows[::-1] + [(77777, "unlabelled")]), table, max_examples=20)


def test_lines_of_a_mixed_text(docs, spark):
    rows, labels = labelled(9)
    weights = quality.fit(docs(rows), spark.createDataFrame(labels, "doc_id long, quality int"))
    text = "\n".join(["Alpha one goes here with beta two and gamma three."] * 3 + [" | ".join(["word"] * 15)] * 6)
    found = quality.line_labels(docs([(1, text), (2, None)]), weights).orderBy("doc_id", "line").collect()
    assert [(r.doc_id, r.line) for r in found] == [(1, k) for k in range(9)] + [(2, 0)]
    assert [r.good for r in found][5:9] == [False] * 4
