"""Byte-pair encoding with a priority queue of merge ranks over a linked symbol list, and decoding.

The vocabulary file is a ``tokenizers`` JSON file of the kind that lower-cases, drops white space and
marks word ends. Ids and decoded text equal the library's.

Defined cases: a null text counts as empty; an empty text has no ids and decodes to the empty text;
repeated rows are encoded each for itself; a text of any length is encoded whole; other columns pass by.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from roomtide.llm.support import Memo, column_rows, ship

# Fixed values of the vocabulary's format: its word pattern, and over ASCII alone, and its white space.
LATIN_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# Characters that Python's split counts as white space and the vocabulary's pattern does not.
CONTROL = re.compile("[\x1c-\x1f]")
# Below this code point, composed letters need no normalization.
PLAIN_LATIN = "\u0250"
REMEMBERED_CHUNKS = 120_000
REMEMBERED_WORDS = 250_000
PLACES = 1 << 32  # more than the longest text has


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class BpeCodec:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [""] * (1 + max(*vocab.values(), *self.special.values()))
        for text, number in (*vocab.items(), *self.special.items()):
            self.strings[number] = text
        self.inner = [vocab[c] for c in byte_alphabet()]
        self.last = [vocab[c + suffix] for c in byte_alphabet()]
        self.ranks, self.merged = {}, []
        for rank, (left, right) in enumerate(spec["model"]["merges"]):
            self.ranks.setdefault(vocab[left] << 20 | vocab[right], rank)
            self.merged.append(vocab[left + right])
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.library = Tokenizer.from_file(path)
        self.words = Memo(self._encode_word, REMEMBERED_WORDS)
        self.chunks = Memo(self._encode_chunk, REMEMBERED_CHUNKS)

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge the adjacent pair of lowest rank, the leftmost first, until no pair has a rank.

        The queue holds rank and place. An entry is stale if its place is gone or its pair has changed.
        """
        n = len(symbols)
        ranks, merged = self.ranks.get, self.merged
        queue = []
        for place in range(n - 1):
            rank = ranks(symbols[place] << 20 | symbols[place + 1])
            if rank is not None:
                queue.append(rank * PLACES + place)
        if not queue:
            return symbols
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        symbols = [*symbols, -1]  # the end: a place without a symbol
        heapify(queue)
        while queue:
            rank, place = divmod(heappop(queue), PLACES)
            symbol, follower = symbols[place], after[place]
            if symbol < 0 or symbols[follower] < 0 or ranks(symbol << 20 | symbols[follower]) != rank:
                continue
            symbols[place] = symbol = merged[rank]
            symbols[follower] = -1
            follower = after[place] = after[follower]
            if follower < n:
                before[follower] = place
                found = ranks(symbol << 20 | symbols[follower])
                if found is not None:
                    heappush(queue, found * PLACES + place)
            leader = before[place]
            if leader >= 0:
                found = ranks(symbols[leader] << 20 | symbol)
                if found is not None:
                    heappush(queue, found * PLACES + leader)
        return [s for s in symbols if s >= 0]

    def _encode_word(self, word: str) -> bytes:
        raw = word.encode()
        symbols = [self.inner[b] for b in raw]
        symbols[-1] = self.last[raw[-1]]
        return pack(f"<{len(ids)}I", *ids) if (ids := self.merge(symbols)) else b""

    def _encode_chunk(self, chunk: str) -> bytes:
        """Ids of a text without white space, as little-endian 32-bit integers."""
        if chunk.isascii():
            chunk = chunk.lower()
            words = (chunk,) if chunk.isalpha() else ASCII_WORD.findall(chunk)
        elif max(chunk) < PLAIN_LATIN:
            words = LATIN_WORD.findall(chunk.lower())
        else:
            words = self._library_words(chunk)
        return b"".join(map(self.words.__getitem__, words))

    def _library_words(self, chunk: str) -> list[str]:
        """Words by the library's own character tables, which may be older or newer than Python's."""
        plain = self.library.normalizer.normalize_str(chunk)
        return [plain[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def encode_bytes(self, text: str) -> bytes:
        if "<|" in text:
            parts = self.splitter.split(text)
            return b"".join(
                np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._encode_plain(p)
                for p in parts
            )
        return self._encode_plain(text)

    def _encode_plain(self, text: str) -> bytes:
        chunks = [c for c in SPACE.split(text) if c] if CONTROL.search(text) else text.split()
        return b"".join(map(self.chunks.__getitem__, chunks))

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text or ""), "<u4")

    def decode(self, ids) -> str:
        """The vocabulary's strings, a space between them, as the library joins them for this kind of file."""
        return " ".join(map(self.strings.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str) -> BpeCodec:
    """One codec per worker process, so that what it has learned of frequent words serves later tasks."""
    return BpeCodec(path)


def _outside(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that would clash with the added ones; names match without regard to case."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int); a column ``ids`` of the input is replaced."""
    ship(docs.sparkSession)
    kept = _outside(docs, "ids")
    schema = T.StructType([*kept.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            ids = pa.array([coder.encode(t).astype(np.int32) for t in texts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "ids"])

    return kept.mapInArrow(run, schema)


def decode_documents(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``; null ids decode to the empty text."""
    ship(docs.sparkSession)
    kept = _outside(docs, "decoded")
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            decoded = pa.array([coder.decode(r or ()) for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "decoded"])

    return kept.mapInArrow(run, schema)


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode each whole text, decode the ids, and keep the digests of both: one pass, no ids are moved."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for doc_ids, texts in column_rows(batches, "doc_id", "text"):
            counts, encoded, decoded = [], [], []
            for text in texts:
                raw = coder.encode_bytes(text or "")
                ids = np.frombuffer(raw, "<u4").tolist()
                counts.append(len(ids))
                encoded.append(hashlib.sha256(raw).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, DIGESTS)
