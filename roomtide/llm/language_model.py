"""Language-model scores: a corpus-wide bigram model in Elias-Fano tries, dealt over shards.

1. Each task cuts its documents into chunks of about two million tokens. A chunk asks every shard for what
   it needs: its distinct words with their training counts, and its distinct bigrams with theirs. The
   same rows count and ask, so no word is shuffled more often than once for each chunk.
2. A shard adds up the counts of its words, and builds a trie of its bigrams (``elias_fano``), each with its discounted
   probability (c(v, w) - D) / c(v) in one byte. It answers each chunk from the trie. A context's successors are in
   one shard; those of a word that makes up more than an eighth of a shard's mean load are spread over eight, of which
   a chunk then asks all. There are fewer such words than eight times the shards, found by counts over all chunks.
3. Each chunk puts the answers together: P(w | v) = trie + D * N1(v) / c(v) * P1(w), where N1(v) is the number of
   distinct successors and P1(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)); after an unknown v it is P1(w).

A text is its lower-cased (A-Z) words and one end token, after a start token that is not counted. Words are known by
64-bit hashes.

Defined cases: a null or empty text is the end token alone; a null doc_id is neither learned from nor held out; repeated
rows count and are scored as often as they occur; without training documents every probability is that of an
unknown word; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.llm.elias_fano import NgramTrie, dequantised
from roomtide.llm.support import column_rows, ship, stored

CHUNK_TOKENS = 1 << 21
SPREAD = 8  # parts of a common context's successors, by the top three bits of their hash
STRIDE = np.uint64(0x9E3779B1)
DISCOUNT = 0.75
FOLDS, HELD_OUT = 5, 1
START, END = np.uint64(1), np.uint64(2)
LEVEL = 1


def _packed(array: np.ndarray) -> bytes:
    """Compressed by byte planes: the high bytes of counts and places are mostly zero."""
    raw = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T
    return zstandard.compress(np.ascontiguousarray(raw).tobytes(), LEVEL)


def _unpacked(blob: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.decompress(blob, max_output_size=1 << 31), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(kind).reshape(-1)


def token_hashes(text: str | None) -> np.ndarray:
    """Hashes of the text's words and the end token."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    hashes = np.empty(len(words) + 1, np.uint64)
    hashes[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    hashes[-1] = END
    return hashes


class Chunk:
    """Documents' tokens as places in a sorted vocabulary, and their distinct bigrams."""

    def __init__(self, vocabulary: np.ndarray, places: np.ndarray, sizes: np.ndarray):
        self.vocabulary, self.places, self.sizes = vocabulary, places, sizes
        ends = np.cumsum(sizes)
        contexts = np.empty(len(places), np.int64)
        contexts[1:] = places[:-1]
        contexts[np.r_[0, ends[:-1]]] = np.searchsorted(vocabulary, START)
        self.context_uses = np.bincount(contexts, minlength=len(vocabulary))
        pairs, self.pair_of = np.unique(contexts * len(vocabulary) + places, return_inverse=True)
        self.first, self.second = pairs // max(1, len(vocabulary)), pairs % max(1, len(vocabulary))

    @classmethod
    def of(cls, hashes: list[np.ndarray]) -> Chunk:
        sizes = np.array([len(h) for h in hashes], np.int64)
        vocabulary = np.unique(np.concatenate([*hashes, [START]]))
        return cls(vocabulary, np.searchsorted(vocabulary, np.concatenate(hashes)), sizes)

    def marks(self) -> np.ndarray:
        return (self.vocabulary >> np.uint64(32)).astype(np.uint32)

    def word_shards(self, shards: int) -> np.ndarray:
        return (self.vocabulary % np.uint64(shards)).astype(np.int64)

    def deal(self, shards: int, common: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each shard: places of its contexts, how many successors each has here, and places of the bigrams.

        A common context is listed in all its shards, with or without successors there.
        """
        spread = np.isin(self.vocabulary, common)
        part = (self.vocabulary >> np.uint64(61))[self.second] * spread[self.first]
        shard = ((self.vocabulary[self.first] + part * STRIDE) % np.uint64(shards)).astype(np.int64)
        every = np.flatnonzero(spread & (self.context_uses > 0))
        homes = [(self.vocabulary[every] + np.uint64(p) * STRIDE) % np.uint64(shards) for p in range(SPREAD)]
        dealt = []
        for number, pairs in enumerate(_grouped(shard, shards)):
            first = self.first[pairs]
            here = every[np.any([h == number for h in homes], axis=0)] if len(every) else every
            contexts = np.union1d(first, here).astype(np.int64)
            dealt.append((contexts, np.diff(np.searchsorted(first, np.r_[contexts, len(self.vocabulary)])), pairs))
        return dealt


def _grouped(shard: np.ndarray, shards: int) -> list[np.ndarray]:
    """Places of each shard, ascending."""
    order = np.argsort(shard, kind="stable")
    return np.split(order, np.searchsorted(shard[order], np.arange(1, shards)))


_CHUNKS = "chunk long, doc_ids array<long>, held_out array<boolean>, sizes array<long>, vocabulary binary, places binary, common array<long>, uses array<long>"
_ASKED = "shard int, chunk long, words binary, word_counts binary, contexts binary, context_counts binary, successors binary, marks binary, counts binary"


def _chunk_table(docs: DataFrame, shards: int, chunk_tokens: int) -> DataFrame:
    """Chunks, with the contexts that are common in them: at most 2 * SPREAD * shards each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        ids, held, hashes, tokens = [], [], [], 0

        def close():
            chunk = Chunk.of(hashes)
            common = np.flatnonzero(chunk.context_uses * SPREAD * shards >= len(chunk.places))
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
                 pa.array([chunk.sizes.tolist()], pa.list_(pa.int64())),
                 pa.array([_packed(chunk.vocabulary)], pa.binary()), pa.array([_packed(chunk.places.astype(np.uint32))], pa.binary()),
                 pa.array([chunk.vocabulary[common].view(np.int64).tolist()], pa.list_(pa.int64())),
                 pa.array([chunk.context_uses[common].tolist()], pa.list_(pa.int64()))],
                ["chunk", "doc_ids", "held_out", "sizes", "vocabulary", "places", "common", "uses"],
            )

        for rows in column_rows(batches, "doc_id", "text", "held_out"):
            for doc_id, text, out in zip(*rows):
                ids.append(doc_id)
                held.append(out)
                hashes.append(token_hashes(text))
                tokens += len(hashes[-1])
                if tokens >= chunk_tokens:
                    yield close()
                    number += 1
                    ids, held, hashes, tokens = [], [], [], 0
        if ids:
            yield close()

    return docs.mapInArrow(run, _CHUNKS)


def _load(batch: pa.RecordBatch, row: int) -> tuple[Chunk, list, list]:
    value = lambda name: batch.column(batch.schema.get_field_index(name))[row].as_py()
    sizes = np.array(value("sizes"), np.int64)
    chunk = Chunk(_unpacked(value("vocabulary"), "<u8"), _unpacked(value("places"), "<u4").astype(np.int64), sizes)
    return chunk, value("doc_ids"), value("held_out")


def _common(chunks: DataFrame, shards: int) -> np.ndarray:
    """Hashes of the contexts with 1 / (SPREAD * shards) of all uses or more: that bounds how many there are.

    Such a context has that share of some chunk at least, so each chunk names its own common ones only.
    """
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n))).first()[0] or 0
    named = chunks.select(F.explode(F.arrays_zip("common", "uses")).alias("c")).groupBy(F.col("c.common").alias("hash"))
    rows = named.agg(F.sum("c.uses").alias("uses")).filter(F.col("uses") * SPREAD * shards >= total).collect()
    return np.sort(np.array([r.hash for r in rows], np.int64).view(np.uint64))


def _asked(chunks: DataFrame, shards: int, common: np.ndarray) -> DataFrame:
    """What each chunk brings to and asks of each shard. A null fold is not learned from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk, _, held = _load(batch, row)
                learned = np.repeat(np.array([h is False for h in held], np.float64), chunk.sizes)
                word_counts = np.bincount(chunk.places, learned, len(chunk.vocabulary)).astype(np.uint32)
                pair_counts = np.bincount(chunk.pair_of, learned, len(chunk.first)).astype(np.uint32)
                context_counts = np.bincount(chunk.first, pair_counts, len(chunk.vocabulary)).astype(np.uint32)
                marks = chunk.marks()
                by_word = _grouped(chunk.word_shards(shards), shards)
                dealt = chunk.deal(shards, common)
                columns = [[] for _ in range(9)]
                number = batch.column(0)[row].as_py()
                for shard in range(shards):
                    words, (contexts, successors, pairs) = by_word[shard], dealt[shard]
                    made = (
                        shard, number, _packed(chunk.vocabulary[words]), _packed(word_counts[words]),
                        _packed(chunk.vocabulary[contexts]), _packed(context_counts[contexts]),
                        _packed(successors.astype(np.uint32)), _packed(marks[chunk.second[pairs]]),
                        _packed(pair_counts[pairs]),
                    )
                    for column, value in zip(columns, made):
                        column.append(value)
                kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 7
                names = [field.split()[0] for field in _ASKED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return chunks.mapInArrow(run, _ASKED)


def _answer(discount: float):
    """A shard's counts, its trie, and its answers."""

    def run(table: pa.Table) -> pa.Table:
        column = lambda name, kind: [_unpacked(b, kind) for b in table[name].to_pylist()]
        words, word_counts = column("words", "<u8"), column("word_counts", "<u4")
        known, place = np.unique(np.concatenate(words), return_inverse=True)
        totals = np.bincount(place, np.concatenate(word_counts), len(known)).astype(np.uint64)
        totals_of = np.split(totals[place], np.cumsum([len(w) for w in words])[:-1])

        contexts, successors = column("contexts", "<u8"), column("successors", "<u4")
        marks, counts = column("marks", "<u4"), column("counts", "<u4")
        all_contexts, number = np.unique(np.concatenate(contexts), return_inverse=True)
        context_counts = np.bincount(number, np.concatenate(column("context_counts", "<u4")), len(all_contexts))
        of_pair = np.repeat(number, np.concatenate(successors))
        keys, key_of = np.unique((of_pair.astype(np.uint64) << np.uint64(32)) | np.concatenate(marks), return_inverse=True)
        pair_counts = np.bincount(key_of, np.concatenate(counts), len(keys))
        learned = pair_counts > 0
        # Contexts of no learned bigram stay without successors.
        trie = NgramTrie.load(NgramTrie.build(all_contexts, np.maximum(context_counts, 1), keys[learned], pair_counts[learned], discount).dump())
        distinct = np.bincount((keys[learned] >> np.uint64(32)).astype(np.int64), minlength=len(all_contexts)).astype(np.uint32)
        distinct_of = np.split(distinct[number], np.cumsum([len(c) for c in contexts])[:-1])
        codes = [
            _packed(trie.lookup(np.repeat(c, s), m)) for c, s, m in zip(contexts, successors, marks)
        ]
        rows = table.num_rows
        return pa.table({
            "shard": table["shard"], "chunk": table["chunk"],
            "totals": pa.array([_packed(t) for t in totals_of], pa.binary()),
            "codes": pa.array(codes, pa.binary()),
            "distinct": pa.array([_packed(d) for d in distinct_of], pa.binary()),
            "tokens": pa.array([int(totals.sum())] * rows, pa.int64()),
            "words": pa.array([int((totals > 0).sum())] * rows, pa.int64()),
        })

    return run


def _scored(shards: int, common: np.ndarray, discount: float, train_tokens: int, train_words: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {name: [] for name in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")}
        answers = {s: r for r, s in enumerate(right["shard"].to_pylist())}
        for batch in left.to_batches():
            for row in range(batch.num_rows):
                chunk, ids, held = _load(batch, row)
                totals = np.zeros(len(chunk.vocabulary))
                codes = np.zeros(len(chunk.first), np.uint8)
                distinct = np.zeros(len(chunk.vocabulary))
                by_word, dealt = _grouped(chunk.word_shards(shards), shards), chunk.deal(shards, common)
                for shard in range(shards):
                    answer = answers[shard]
                    totals[by_word[shard]] = _unpacked(right["totals"][answer].as_py(), "<u8")
                    contexts, _, pairs = dealt[shard]
                    codes[pairs] = _unpacked(right["codes"][answer].as_py(), "u1")
                    distinct[contexts] += _unpacked(right["distinct"][answer].as_py(), "<u4")
                base = (totals + 0.5) / (train_tokens + 0.5 * (train_words + 1))
                # As contexts, words count as often as they are followed: all of them are. The start is followed once a text.
                followed = totals.copy()
                followed[np.searchsorted(chunk.vocabulary, START)] = totals[np.searchsorted(chunk.vocabulary, END)]
                backoff = np.where(followed > 0, discount * distinct / np.maximum(followed, 1), 1.0)
                pair = np.log10(dequantised(codes) + backoff[chunk.first] * base[chunk.second])
                starts = np.r_[0, np.cumsum(chunk.sizes)[:-1]]
                found["doc_id"] += ids
                found["held_out"] += [bool(h) for h in held]
                found["n_tokens"] += chunk.sizes.tolist()
                found["n_known"] += np.add.reduceat((totals > 0)[chunk.places].astype(np.int64), starts).tolist()
                found["base_score"] += np.add.reduceat(np.log10(base)[chunk.places], starts).tolist()
                found["score"] += np.add.reduceat(pair[chunk.pair_of], starts).tolist()
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({n: pa.array(v, k) for (n, v), k in zip(found.items(), kinds)})

    return run


def score_corpus(docs: DataFrame, discount: float = DISCOUNT, shards: int | None = None,
                 chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    ship(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    chunks = stored(
        _chunk_table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold == HELD_OUT).alias("held_out")), shards, chunk_tokens),
        "chunks",
    )
    common = _common(chunks, shards)
    answers = stored(
        _asked(chunks, shards, common).groupBy("shard").applyInArrow(
            _answer(discount), "shard int, chunk long, totals binary, codes binary, distinct binary, tokens long, words long"
        ),
        "answers",
    )
    sums = answers.groupBy("shard").agg(F.first("tokens").alias("tokens"), F.first("words").alias("words"))
    train = sums.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("v")).first()
    scored = chunks.drop("common", "uses").groupBy("chunk").cogroup(answers.select("shard", "chunk", "totals", "codes", "distinct").groupBy("chunk")).applyInArrow(
        _scored(shards, common, discount, train.n, train.v),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train.n).cast("long").alias("train_tokens"), "base_score", "score")
