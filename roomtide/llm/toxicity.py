"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each counted once: its lower-cased words, the words' beginnings of four to six letters
(which stand for inflected forms), pairs of neighbours, and pairs with one or two words between them. Every
coordinate has its own learning rate, and L1 keeps most weights at exactly zero, so a model is a short list.

Training reads at most ``max_examples`` labelled texts, those of the lowest hash of doc_id, and of these, in the same
order, as many as have ``max_features`` features together (four bytes each): one task holds them. Nothing else is
sampled; every text is scored whole.

Defined cases: null and empty texts have no features and get the score of the bias; a doc_id with several
labels counts as toxic if one of them says so; null labels and null doc_ids are not learned from; without any label
every score is 0.5 - and every prediction 0 - since nothing is known; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.llm.support import Memo, column_rows, ship

WORD = re.compile(r"\w+")
BITS = 20
SIZE = 1 << BITS
STEMS = (4, 5, 6)
REMEMBERED_WORDS = 100_000
HELD_OUT_FOLDS = 5
MAX_EXAMPLES, MAX_FEATURES = 12_000, 40_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def _word(word: str) -> bytes:
    """A word's 64-bit hash, and those of its beginnings."""
    hashes = [xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))]
    for n in STEMS:
        hashes.append(xxhash.xxh3_64_intdigest(word[:n].encode("utf-8", "surrogatepass"), seed=n) if len(word) >= n else 0)
    return np.array(hashes, np.uint64).tobytes()


_words = Memo(_word, REMEMBERED_WORDS)


def features(text: str | None) -> np.ndarray:
    """Hashed feature numbers below 2^20; repeats are left in."""
    words = WORD.findall(text.lower()) if text else []
    if not words:
        return np.empty(0, np.int64)
    table = np.frombuffer(b"".join(map(_words.__getitem__, words)), np.uint64).reshape(-1, 1 + len(STEMS))
    first = table[:, 0]
    stems = table[:, 1:].reshape(-1)
    found = [first, stems[stems != 0]]
    for gap in (1, 2, 3):
        if len(first) > gap:
            found.append((first[:-gap] * MIX) ^ (first[gap:] + np.uint64(gap)))
    return ((np.concatenate(found) * MIX) >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """FTRL-proximal with logistic loss (per-coordinate rates, L1 and L2); the last coordinate is the bias."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 5.0, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - np.where(at == SIZE, 0.0, self.l1), 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, label: int) -> None:
        weights = self.weights(at)
        slope = 1 / (1 + np.exp(-np.clip(weights.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += slope - (np.sqrt(n + slope * slope) - np.sqrt(n)) / self.alpha * weights
        self.n[at] = n + slope * slope


def train(labelled: DataFrame, epochs: int = 4, max_features: int = MAX_FEATURES, **rates: float) -> list[tuple[int, float]]:
    """Non-zero weights from rows (doc_id, text, toxic), at most 2^20 and a bias; a bounded input, one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for ids, texts, labels in column_rows(batches, "doc_id", "text", "toxic"):
            for doc_id, text, label in zip(ids, texts, labels):
                if held > max_features:
                    break
                at = np.append(np.unique(features(text)), SIZE).astype(np.int32)
                held += len(at)
                rows.append((xxhash.xxh3_64_intdigest(str(doc_id)), at, label))
        rows.sort(key=lambda r: (r[0], len(r[1]), r[2]))
        model = Ftrl(**rates)
        for _ in range(epochs if rows else 0):
            for _, at, label in rows:
                model.learn(at, label)
        weights = model.weights(np.arange(SIZE + 1))
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(weights[at], pa.float64())], ["at", "weight"])

    ship(labelled.sparkSession)
    rows = labelled.select("doc_id", "text", "toxic").coalesce(1).mapInArrow(run, "at long, weight double").collect()
    return [(r.at, r.weight) for r in rows]


def _arrays(weights: list[tuple[int, float]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([a for a, _ in weights], np.int64), np.array([w for _, w in weights], np.float64)


class Scorer:
    """A text's score under a list of weights."""

    def __init__(self, at: np.ndarray, weight: np.ndarray):
        self.dense = np.zeros(SIZE + 1)
        self.dense[at] = weight
        self.kept, self.trained = self.dense != 0, len(at) > 0

    def score(self, text: str | None) -> float:
        found = features(text)
        found = np.unique(found[self.kept[found]])
        return float(1 / (1 + np.exp(-np.clip(self.dense[found].sum() + self.dense[SIZE], -35, 35))))

    def predicted(self, score: float) -> int:
        return int(score >= 0.5) if self.trained else 0


def score(docs: DataFrame, weights: list[tuple[int, float]], text: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted of every row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(_arrays(weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for ids, texts in column_rows(batches, "doc_id", "text"):
            scores = [scorer.score(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(scores, pa.float64()),
                 pa.array([scorer.predicted(s) for s in scores], pa.int32())],
                ["doc_id", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def accepted(docs: DataFrame, weights: list[tuple[int, float]], text: str = "text") -> DataFrame:
    """``docs``, all columns as they are, without the rows that are predicted toxic."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(_arrays(weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                stay = np.array([scorer.predicted(scorer.score(t)) == 0 for t in texts], bool)
                yield part.filter(pa.array(stay))

    return docs.mapInArrow(run, docs.schema)


def fold(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % HELD_OUT_FOLDS


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, max_features: int = MAX_FEATURES) -> list[tuple[int, float]]:
    """Weights learned from the labelled rows outside the held-out fold."""
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold() != 0))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_examples)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = texts.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
    return train(known, max_features=max_features)


def score_documents(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, max_features: int = MAX_FEATURES) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    weights = fit(docs, labels, max_examples, max_features)
    return score(docs, weights).select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted")
