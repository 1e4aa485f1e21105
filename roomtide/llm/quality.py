"""Text quality by a linear-chain conditional random field that labels every line good or bad.

A line is described by binned measures: its length, words, shares of letters, capitals, digits, symbols and doubled
characters, how often its words repeat, its first and last character, how often the line comes in its text and where.
Each line also has the measures of the line before and after it. The field has a weight for each bin and for each pair
of neighbouring labels; the forward-backward algorithm gives each line's probability of being good, and a text's quality
is their mean, weighted by the lines' lengths plus one. Labels are known for whole documents, so in training a line has
its document's label; the chain then learns how far neighbours agree.

Training reads at most ``max_examples`` labelled documents, those of the lowest hash of doc_id, and of these, in the same
order, whole documents of at most ``max_lines`` lines together; one task holds their bins, 51 bytes a line. Every text is
scored whole.

Defined cases: null and empty texts are one empty line; lines end at line feeds; a doc_id with several labels is bad if one
of them says so; null labels and null doc_ids are not learned from; without any label all scores are 0.5; extra columns
are not read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.llm.support import column_rows, ship

HELD_OUT_FOLDS = 5
THRESHOLD = 0.3
CHARS_AT_ONCE = 1 << 21
LINES_AT_ONCE = 1 << 16
SPACE, LOWER, UPPER, DIGIT, STOP, POINT, SYMBOL, NONE = range(8)


def _class(char: str) -> int:
    kind = unicodedata.category(char)
    if char.isspace() or kind[0] == "Z":
        return SPACE
    if kind in ("Lu", "Lt"):
        return UPPER
    if kind[0] in "LM":
        return LOWER
    if kind[0] == "N":
        return DIGIT
    if char in ".!?…。！？":
        return STOP
    return POINT if char in ",;:'\"-()[]«»“”‘’–—¿¡" else SYMBOL


CLASSES = np.array([_class(chr(c)) for c in range(0x3100)], np.uint8)  # beyond: letters of one case
SHARES = np.array([0.001, 0.01, 0.03, 0.06, 0.1, 0.2, 0.3, 0.45, 0.6, 0.8, 0.95, 0.999])
COUNTS = 2.0 ** np.arange(12)
LENGTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24])
BINS = 13
MEASURES = 17
MIX = np.uint64(0x9E3779B97F4A7C15)


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[ends] - total[starts]


def _measured(lines: list[str]) -> np.ndarray:
    """The first 14 measures of each line, as bins."""
    n = len(lines)
    lengths = np.fromiter(map(len, lines), np.int64, n)
    chars = np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
    ends = starts + lengths
    kinds = np.full(len(chars) + 1, SPACE, np.uint8)
    kinds[:-1] = np.where(chars < len(CLASSES), CLASSES[np.minimum(chars, len(CLASSES) - 1)], LOWER)
    visible = kinds[:-1] != SPACE
    count = [_sums(kinds[:-1] == k, starts, ends) for k in range(NONE)]
    shown = lengths - count[SPACE]
    letters = count[LOWER] + count[UPPER]
    same = np.zeros(len(chars), bool)
    same[1:] = (chars[1:] == chars[:-1]) & visible[1:]

    edge = np.diff(np.concatenate([[0], visible.view(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    words = np.searchsorted(first, ends) - np.searchsorted(first, starts)
    line = np.repeat(np.arange(n), words)
    place = np.arange(len(chars), dtype=np.uint64)
    place -= np.repeat(place[first], last - first + 1)[np.cumsum(visible) - 1] if len(first) else place
    mixed = (chars.astype(np.uint64) + place * np.uint64(0x10FFFF)) * MIX
    mixed ^= mixed >> np.uint64(29)
    mixed *= MIX
    mixed[~visible] = 0
    hashes = np.add.reduceat(mixed, first) if len(first) else np.empty(0, np.uint64)
    again = np.zeros(len(first), bool)
    if len(first):
        again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
        order = np.lexsort((hashes, line))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line[order][1:] != line[order][:-1])
        distinct = np.bincount(line[order][new], minlength=n)
    else:
        distinct = np.zeros(n, np.int64)
    odd = np.isin(kinds[last], (SYMBOL,)) | (same[last] & ~np.isin(kinds[last], (LOWER, UPPER, DIGIT)))

    def share(part, whole):
        return np.digitize(part / np.maximum(whole, 1), SHARES)

    at = np.minimum(np.searchsorted(first, starts), max(len(first) - 1, 0))
    to = np.maximum(np.searchsorted(first, ends) - 1, 0)
    none = words == 0
    opens = np.where(none, NONE, kinds[first[at]] if len(first) else NONE)
    closes = np.where(none, NONE, kinds[last[to]] if len(first) else NONE)
    return np.stack(
        [
            np.digitize(lengths, COUNTS), np.digitize(words, COUNTS), np.digitize(shown / np.maximum(words, 1), LENGTHS),
            share(letters, shown), share(count[UPPER], letters), share(count[DIGIT], shown), share(count[SYMBOL], shown),
            share(count[POINT] + count[STOP], shown), share(_sums(same, starts, ends), shown), share(distinct, words),
            share(np.bincount(line[again], minlength=n), words), share(np.bincount(line[odd], minlength=n), words), opens, closes,
        ],
        axis=1,
    ).astype(np.uint8)


def described(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of every line of the texts, with those of its neighbours, the lines' weights and each text's lines."""
    split = [(t or "").split("\n") for t in texts]
    lines = [line for one in split for line in one]
    found, start, chars = [], 0, 0
    for i, line in enumerate(lines):
        chars += len(line) + 1
        if chars >= CHARS_AT_ONCE or i + 1 == len(lines):
            found.append(_measured(lines[start : i + 1]))
            start, chars = i + 1, 0
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    weights = np.fromiter(map(len, lines), np.int64, len(lines)) + 1
    ends = np.cumsum(sizes)
    own = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(lines)) - np.repeat(ends - sizes, sizes)
    often = [[times[line] for line in one] for one in split for times in (Counter(one),)]
    repeated = np.array([n for one in often for n in one], np.int64)
    where = np.where(place == 0, 0, np.where(place == sizes[own] - 1, 11, 1 + place * 10 // np.maximum(sizes[own], 1)))
    more = np.stack([np.digitize(repeated, COUNTS), np.digitize(sizes[own], COUNTS), where], axis=1)
    bins = np.concatenate([np.concatenate(found), more], axis=1).astype(np.int64)
    bins += np.arange(MEASURES) * BINS
    size = MEASURES * BINS + 1  # the last one of each part: no such neighbour
    before, after = np.full_like(bins, size - 1), np.full_like(bins, size - 1)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    before[ends - sizes], after[ends - 1] = size - 1, size - 1
    return np.concatenate([bins, before + size, after + 2 * size], axis=1).astype(np.int16), weights, sizes


FEATURES = 3 * (MEASURES * BINS + 1)


class Field:
    """The conditional random field: weights of features for "good", start scores and scores of neighbouring labels."""

    def __init__(self, weights: np.ndarray | None = None):
        self.w = np.zeros(FEATURES + 6) if weights is None else weights

    @property
    def emission(self) -> np.ndarray:
        return self.w[:FEATURES]

    def chain(self, features: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each line's probabilities (bad, good); expected starts and neighbouring pairs, summed over texts."""
        odds = np.clip(self.emission[features].sum(axis=1), -40, 40)
        local = np.exp(np.stack([-odds / 2, odds / 2], axis=1))
        start, pairs = np.exp(self.w[FEATURES : FEATURES + 2]), np.exp(self.w[FEATURES + 2 :].reshape(2, 2))
        order = np.argsort(-sizes, kind="stable")
        firsts = (np.cumsum(sizes) - sizes)[order]
        active = np.searchsorted(-sizes[order], -np.arange(1, sizes.max() + 1), side="right")
        ahead, back = np.empty_like(local), np.ones_like(local)
        now = start * local[firsts]
        for t, n in enumerate(active):
            at = firsts[:n] + t
            if t:
                now = (now[:n] @ pairs) * local[at]
            now = now / now.sum(axis=1, keepdims=True)
            ahead[at] = now
        crossed = np.zeros((2, 2))
        for t in range(len(active) - 1, 0, -1):
            at = firsts[: active[t]] + t
            coming = local[at] * back[at]
            joint = ahead[at - 1][:, :, None] * pairs * coming[:, None, :]
            crossed += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            earlier = coming @ pairs.T
            back[at - 1] = earlier / earlier.sum(axis=1, keepdims=True)
        both = ahead * back
        both /= both.sum(axis=1, keepdims=True)
        return both, both[firsts].sum(axis=0), crossed

    def gradient(self, features: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Of the log-likelihood of the lines' labels."""
        both, starts, crossed = self.chain(features, sizes)
        missed = np.repeat(labels - both[:, 1], features.shape[1])
        slope = np.zeros_like(self.w)
        slope[:FEATURES] = np.bincount(features.reshape(-1), missed, FEATURES)
        firsts = np.cumsum(sizes) - sizes
        slope[FEATURES : FEATURES + 2] = np.bincount(labels[firsts], minlength=2) - starts
        inner = np.ones(len(labels), bool)
        inner[firsts] = False
        seen = np.bincount(2 * labels[np.flatnonzero(inner) - 1] + labels[inner], minlength=4)
        slope[FEATURES + 2 :] = seen - crossed.reshape(-1)
        return slope


def fit_field(features: np.ndarray, sizes: np.ndarray, labels: np.ndarray, epochs: int = 12, rate: float = 0.03,
              l2: float = 1.0, batch: int = 128, seed: int = 1) -> Field:
    """Adam over mini-batches of whole texts; ``labels`` has one label for each text."""
    field, rng = Field(), np.random.default_rng(seed)
    firsts = np.cumsum(sizes) - sizes
    mean, square, step = np.zeros_like(field.w), np.zeros_like(field.w), 0
    for epoch in range(epochs):
        order = rng.permutation(len(sizes))
        for k in range(0, len(order), batch):
            chosen = order[k : k + batch]
            lines = np.concatenate([np.arange(firsts[i], firsts[i] + sizes[i]) for i in chosen])
            slope = field.gradient(features[lines], sizes[chosen], np.repeat(labels[chosen], sizes[chosen])) / len(chosen)
            slope -= l2 * field.w / len(sizes)
            step += 1
            mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope * slope
            pace = rate * (1 - epoch / epochs)
            field.w = field.w + pace * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return field


def _pieces(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Neighbouring texts, a bounded number of characters and lines at a time; one longer text is a piece of its own."""
    piece, chars, lines = [], 0, 0
    for text in texts:
        piece.append(text)
        chars += len(text or "")
        lines += (text or "").count("\n") + 1
        if chars >= CHARS_AT_ONCE or lines >= LINES_AT_ONCE:
            yield piece
            piece, chars, lines = [], 0, 0
    if piece:
        yield piece


def line_qualities(field: Field, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each line's probability of being good and weight, and each text's number of lines."""
    features, weights, sizes = described(texts)
    return field.chain(features, sizes)[0][:, 1], weights, sizes


def qualities(field: Field, texts: list[str | None]) -> np.ndarray:
    scores = []
    for piece in _pieces(texts):
        good, weights, sizes = line_qualities(field, piece)
        firsts = np.cumsum(sizes) - sizes
        scores.append(np.add.reduceat(good * weights, firsts) / np.add.reduceat(weights, firsts))
    return np.clip(np.concatenate(scores), 0, 1) if scores else np.empty(0)


def fold(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % HELD_OUT_FOLDS


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = 12_000, max_lines: int = 2_000_000) -> list[float]:
    """The field's weights, learned from the labelled documents outside the held-out fold; empty without any."""
    spark = docs.sparkSession
    ship(spark)
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold() != 0))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(F.col("quality").cast("int")).alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_examples)
    )

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, known in column_rows(batches, "doc_id", "text", "quality"):
            done = 0
            for piece in _pieces(texts):
                features, _, sizes = described(piece)
                ends = np.cumsum(sizes)
                packed = [features[e - s : e].tobytes() for s, e in zip(sizes, ends)]
                part = slice(done, done + len(piece))
                done += len(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[part], pa.int64()), pa.array(known[part], pa.int32()), pa.array(packed, pa.binary())],
                    ["doc_id", "quality", "lines"],
                )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, lines = [], 0
        for _, known, packed in column_rows(batches, "doc_id", "quality", "lines"):
            for label, one in zip(known, packed):
                features = np.frombuffer(one, np.int16).reshape(-1, 3 * MEASURES)
                if lines + len(features) > max_lines:
                    break
                lines += len(features)
                rows.append((features, label))
        weights = []
        if rows:
            sizes = np.array([len(f) for f, _ in rows])
            weights = fit_field(np.concatenate([f for f, _ in rows]), sizes, np.array([y for _, y in rows])).w.tolist()
        yield pa.RecordBatch.from_arrays([pa.array([weights], pa.list_(pa.float64()))], ["weights"])

    known = _texts(docs).join(F.broadcast(chosen), "doc_id")
    binned = known.mapInArrow(bins, "doc_id long, quality int, lines binary")
    ordered = binned.orderBy(F.xxhash64("doc_id"), "doc_id", "lines").limit(max_examples)
    return [w for r in ordered.coalesce(1).mapInArrow(train, "weights array<double>").collect() for w in r.weights]


def score_documents(docs: DataFrame, labels: DataFrame, max_examples: int = 12_000, max_lines: int = 2_000_000) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if the score is 0.3 or more) of every document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(np.array(fit(docs, labels, max_examples, max_lines)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(shared.value if len(shared.value) else None)
        for ids, texts in column_rows(batches, "doc_id", "text"):
            scores = qualities(field, texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(scores, pa.float64()), pa.array(scores >= THRESHOLD).cast(pa.int32())],
                ["doc_id", "score", "predicted"],
            )

    scored = _texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def line_labels(docs: DataFrame, weights: list[float]) -> DataFrame:
    """(doc_id, line, quality, good) of every line of every document."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(np.array(weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(shared.value if len(shared.value) else None)
        for ids, texts in column_rows(batches, "doc_id", "text"):
            done = 0
            for piece in _pieces(texts):
                good, _, sizes = line_qualities(field, piece)
                own = [ids[done + i] for i in np.repeat(np.arange(len(sizes)), sizes)]
                done += len(piece)
                number = np.arange(len(good)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array(number, pa.int64()), pa.array(good), pa.array(good >= 0.5)],
                    ["doc_id", "line", "quality", "good"],
                )

    return _texts(docs).mapInArrow(run, "doc_id long, line long, quality double, good boolean")
