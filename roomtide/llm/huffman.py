"""Token ids in files, as canonical length-limited Huffman codes from global counts.

Writing: texts are encoded once, many at a time, and their ids kept in a scratch table; ids are counted over all documents; the
counts give code lengths (package-merge, at most 20 bits) and canonical codes; documents are dealt in ascending
doc_id order and each run of whole documents becomes a segment, one row of a Parquet file.

Format: ``codes`` holds the code length of every id. ``segments`` holds part (ascending doc_id), segment (ascending
within the part), doc_ids, n_tokens (of each document, its end id included), bits (the codes, first bit highest
in each 64-bit big-endian word) and checkpoints: the bit offset of every 256th id, so that each block of 256
ids can be read by itself. Reading looks up the next 20 bits of each block in one table of 2^20 entries, all
blocks of a segment side by side.

Defined cases: a null or empty text has the end id alone; a null doc_id sorts first; repeated rows are written
as often as they occur, equal doc_ids one after the other; an empty table gives no segments and no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roomtide.llm.bpe import byte_alphabet
from roomtide.llm.merges import LONGEST_WORD, Merges
from roomtide.llm.support import column_rows, scratch, ship, stored

LONGEST_CODE = 20
BLOCK_IDS = 256
SEGMENT_IDS = 1 << 18
BATCH_PIECES = 1 << 18
BATCH_CHARACTERS = 1 << 21
REMEMBERED_PIECES = 1 << 20
PLACES = 1 << 21
LONGEST_PIECE = 23
MIXERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
# A key is a piece's bytes and, in its last byte, the size. By size: the bytes that are the piece's own, and the size.
KEPT_BYTES = np.where(np.arange(LONGEST_PIECE + 1) < np.arange(LONGEST_PIECE + 1)[:, None], 255, 0).astype(np.uint8).view("<u8")
SIZE_BYTES = np.arange(LONGEST_PIECE + 1, dtype=np.uint64) << np.uint64(56)
PATTERN_PIECES = 1 << 13

MODEL_OPTIONS = (
    "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges",
)
# The vocabulary's pattern, with its classes written out for texts of Latin letters.
SPACES = "\t-\r \x85\xa0"
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_END = "\u0250"
OTHER_SPACES = "\t\n\v\f\r\x85\xa0"
WORD = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)

# Kinds of characters by their bytes in UTF-8; 0 stands behind a piece.
LETTER, NUMBER, OTHER, WHITE, UNTOLD = 1, 2, 3, 4, 5
KINDS = np.full(256, OTHER, np.int8)
KINDS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0xC0), *range(0xC3, 0xC9)]] = LETTER
KINDS[ord("0") : ord("9") + 1] = NUMBER
KINDS[[*range(ord("\t"), ord("\r") + 1), ord(" ")]] = WHITE
KINDS[[ord("'"), *range(0xC0, 0xC3), *range(0xC9, 0x100)]] = UNTOLD


class WordEncoder:
    """The library's encoder, for many texts at once, with the ids of pieces between spaces remembered.

    The vocabulary never merges across the words of its pattern, so the words' ids are the text's. A space after a
    visible character begins a word of the pattern, so the pieces from each such space to the next are encoded apart.
    Texts where a space follows white space are matched whole, and their words are the pieces; texts with characters
    beyond the Latin ones or with special tokens are left to the library. Ids are little-endian, of two bytes if the
    vocabulary's fit.

    Pieces of up to ``LONGEST_PIECE`` bytes are numbered as they come. ``table`` holds a piece's number at the place its
    bytes give or behind it, with no free place between, and ``keys`` its bytes and size, which are compared whole.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        added = self.library.get_added_tokens_decoder()
        self.special = [token.content for token in added.values()]
        alphabet = byte_alphabet()
        self.shown = {c: "".join(alphabet[b] for b in chr(c).encode()) for c in range(ord(LATIN_END))}
        self.size = self.library.get_vocab_size()
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)["model"]
        vocab, pairs = spec["vocab"], [m.split(" ") if isinstance(m, str) else m for m in spec["merges"]]
        # Words are left to the library if merges alone do not tell their ids.
        plain = not any(spec.get(option) for option in MODEL_OPTIONS) and all(c in vocab for c in alphabet)
        self.longest = LONGEST_WORD if plain else 0
        pairs = pairs if plain else []
        self.merges = Merges(
            np.array([(vocab[a], vocab[b]) for a, b in pairs], np.int64).reshape(-1, 2),
            np.array([vocab[a + b] for a, b in pairs], np.int64), np.array([vocab.get(c, 0) for c in alphabet]), 1 + max(vocab.values()),
        )
        self._forget()

    def _forget(self) -> None:
        self.table = np.full(PLACES, -1, np.int32)
        self.keys = np.zeros((REMEMBERED_PIECES, len(MIXERS)), np.uint64)
        self.starts, self.counts = np.zeros(REMEMBERED_PIECES, np.int64), np.zeros(REMEMBERED_PIECES, np.int64)
        self.known, self.whole, self.ids = 0, True, np.zeros(0, self.kind)

    def _words(self, padded: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words, and each one's start and count; long words are left to the library."""
        long = sizes > self.longest
        ids, starts, counts = self.merges(padded, begins, np.where(long, 0, sizes))
        parts, done = [ids.astype(self.kind)], len(ids)
        for k in np.flatnonzero(long).tolist():
            word = padded[begins[k] : begins[k] + sizes[k]].tobytes().decode()
            found = [token.id for token in self.model.tokenize(word.translate(self.shown))]
            starts[k], counts[k] = done, len(found)
            parts.append(np.array(found, self.kind))
            done += len(found)
        return np.concatenate(parts), starts, counts

    def _pieces(self, padded: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces, and each one's start and count, by way of their words."""
        words, word_sizes, firsts, done = [], [], [], 0
        for k in range(0, len(begins), PATTERN_PIECES):
            part = slice(k, k + PATTERN_PIECES)
            size = sizes[part]
            if size.max() <= LONGEST_PIECE:
                first = word_firsts(np.lib.stride_tricks.sliding_window_view(padded, LONGEST_PIECE + 1)[begins[part]], size)
                row, column = np.nonzero(first)
                at = begins[part][row] + column
            else:
                found = [pattern_sizes(padded[b : b + n].tobytes()) for b, n in zip(begins[part].tolist(), size.tolist())]
                row = np.repeat(np.arange(len(found)), [len(f) for f in found])
                ends = np.cumsum([n for f in found for n in f])
                at = np.r_[0, ends[:-1]] + (begins[part] - np.cumsum(size) + size)[row]
            begun = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            last = np.r_[begun[1:], len(row)] - 1
            until = np.r_[at[1:], 0]
            until[last] = begins[part] + size
            words.append(at)
            word_sizes.append(until - at)
            firsts.append(begun + done)
            done += len(at)
        ids, starts, counts = self._words(padded, np.concatenate(words), np.concatenate(word_sizes))
        numbers = np.add.reduceat(counts, np.concatenate(firsts))
        return gathered(ids, starts, counts), np.cumsum(numbers) - numbers, numbers

    def _numbered(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of pieces, and of each new one the place in ``keys`` of a row that has it."""
        mixed = keys[:, 0] * MIXERS[0] + keys[:, 1] * MIXERS[1] + keys[:, 2] * MIXERS[2]
        mixed ^= mixed >> np.uint64(32)
        place = (mixed * MIXERS[0] >> np.uint64(65 - PLACES.bit_length())).astype(np.int64)
        numbers = self.table[place].astype(np.int64)
        rows = np.flatnonzero(numbers >= 0)
        while len(rows := rows[unlike(self.keys[numbers[rows]], keys[rows])]):
            place[rows] = place[rows] + 1 & PLACES - 1
            numbers[rows] = now = self.table[place[rows]]
            rows = rows[now >= 0]
        # Each row of a new piece tries for a free place; the last one to write there has it, and equal ones share it.
        rows = new = np.flatnonzero(numbers < 0)
        while len(rows):
            free = self.table[place[rows]] == -1
            self.table[place[rows[free]]] = -2 - rows[free]
            numbers[rows] = holder = self.table[place[rows]]
            other = holder >= 0
            other[~other] = unlike(keys[-2 - holder[~other]], keys[rows[~other]])
            rows = rows[other]
            place[rows] = place[rows] + 1 & PLACES - 1
        held = -2 - numbers[new]
        holders = new[held == new]
        until = self.known + len(holders)
        numbers[holders] = np.arange(self.known, until)
        numbers[new] = numbers[held]
        self.table[place[holders]] = numbers[holders]
        self.keys[self.known : until] = keys[holders]
        return numbers, holders

    def _batch(self, padded: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after the other, and how many each has."""
        if not self.whole or self.known + len(begins) > REMEMBERED_PIECES:
            self._forget()  # left unfinished by a task that failed, or full
        self.whole = False
        starts, counts = np.zeros(len(begins), np.int64), np.zeros(len(begins), np.int64)
        short = np.flatnonzero(sizes <= LONGEST_PIECE)
        keys = np.lib.stride_tricks.sliding_window_view(padded, LONGEST_PIECE + 1)[begins[short]].view("<u8")
        keys &= KEPT_BYTES[sizes[short]]
        keys[:, 2] |= SIZE_BYTES[sizes[short]]
        numbers, new = self._numbered(keys)
        if len(new):
            ids, first, number = self._pieces(padded, begins[short[new]], sizes[short[new]])
            until = self.known + len(new)
            self.starts[self.known : until], self.counts[self.known : until] = first + len(self.ids), number
            self.ids, self.known = np.concatenate([self.ids, ids]), until
        starts[short], counts[short] = self.starts[numbers], self.counts[numbers]
        ids, long = self.ids, np.flatnonzero(sizes > LONGEST_PIECE)
        if len(long):
            more, first, counts[long] = self._pieces(padded, begins[long], sizes[long])
            starts[long], ids = first + len(ids), np.concatenate([ids, more])
        self.whole = True
        return gathered(ids, starts, counts), counts

    def _joined(self, texts: list[bytes], sizes: list[int] | None) -> list[bytes]:
        """The ids of each text, from pieces of the given sizes, or that begin at the texts' beginnings and spaces."""
        raw = b"".join(texts)
        padded = np.frombuffer(raw + bytes(LONGEST_WORD), np.uint8)
        borders = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        if sizes is None:
            first = padded[: len(raw) + 1] == ord(" ")
            first[borders] = True
            ends = np.flatnonzero(first)
            begins, sizes = ends[:-1], np.diff(ends)
        else:
            sizes = np.array(sizes, np.int64)
            begins = np.cumsum(sizes) - sizes
        parts = [
            self._batch(padded, begins[k : k + BATCH_PIECES], sizes[k : k + BATCH_PIECES])
            for k in range(0, len(begins), BATCH_PIECES)
        ]
        ids = np.concatenate([np.zeros(0, self.kind), *(p[0] for p in parts)])
        until = np.cumsum(np.concatenate([np.zeros(1, np.int64), *(p[1] for p in parts)]))
        until = until[np.searchsorted(begins, borders)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(until, until[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        spaced, matched, sizes, held = {}, {}, [], 0

        def flush() -> None:
            for held_texts, held_sizes in ((spaced, None), (matched, sizes)):
                if held_texts:
                    for k, ids in zip(held_texts, self._joined(list(held_texts.values()), held_sizes)):
                        out[k] = ids
                    held_texts.clear()
            sizes.clear()

        for k, text in enumerate(texts):
            if not latin(text) or any(s in text for s in self.special):
                out[k] = np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
                continue
            if "  " in text or any(c in text and c + " " in text for c in OTHER_SPACES):
                matched[k] = text.encode()
                sizes += [len(word.encode()) for word in WORD.findall(text)]
            else:
                spaced[k] = text.encode()
            held += len(text)
            if held >= BATCH_CHARACTERS:
                flush()
                held = 0
        flush()
        return out

    def __call__(self, text: str) -> bytes:
        return self.encode([text])[0]


def unlike(keys: np.ndarray, others: np.ndarray) -> np.ndarray:
    return (keys[:, 0] != others[:, 0]) | (keys[:, 1] != others[:, 1]) | (keys[:, 2] != others[:, 2])


def pattern_sizes(piece: bytes) -> list[int]:
    """Bytes of each word of a piece."""
    return [len(word.encode()) for word in WORD.findall(piece.decode())]


def word_firsts(raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where words begin in pieces, one in each row of ``raw``, which has a column more than the longest piece.

    A word begins where the kind of character changes; a space belongs to the visible character behind it, and of white
    space before a visible character the last one stands alone. Pieces with an apostrophe, or with characters whose kind
    their first byte does not tell, are matched by the pattern itself.
    """
    kinds = np.where(np.arange(raw.shape[1]) < sizes[:, None], KINDS[raw], 0)
    first = np.zeros(kinds.shape, bool)
    before, now, behind = kinds[:, :-2], kinds[:, 1:-1], kinds[:, 2:]
    first[:, 0] = True
    first[:, 1:-1] = (now != 0) & (now != before) & (raw[:, :-2] != ord(" "))
    first[:, 1:-1] |= (now == WHITE) & (behind != 0) & (behind != WHITE)
    signs = (raw[:, :-1] == 0xC3) & ((raw[:, 1:] == 0x97) | (raw[:, 1:] == 0xB7))
    for row in np.flatnonzero((kinds == UNTOLD).any(axis=1) | signs.any(axis=1)).tolist():
        found = pattern_sizes(raw[row, : sizes[row]].tobytes())
        first[row] = False
        first[row, np.cumsum([0, *found[:-1]])] = True
    return first[:, :-1]


def gathered(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` with these starts and counts, one after the other."""
    at = np.repeat(starts - np.cumsum(counts) + counts, counts)
    at += np.arange(len(at))
    return ids[at]


def latin(text: str) -> bool:
    """Whether all characters lie below ``LATIN_END``; most texts are told by a conversion that needs no loop."""
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return max(text) < LATIN_END


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def code_lengths(counts: np.ndarray, longest: int = LONGEST_CODE) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits by package-merge; 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError("more ids than codes")
    leaves = used[np.argsort(counts[used], kind="stable")]
    weights = counts[leaves].astype(np.float64)
    # Each level keeps its sorted list as: is it a leaf, in order. What is chosen of a list is its head.
    levels, merged = [], weights
    is_leaf = np.ones(len(weights), bool)
    for _ in range(longest - 1):
        levels.append(is_leaf)
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        joined = np.concatenate([weights, packages])
        order = np.argsort(joined, kind="stable")
        is_leaf, merged = order < len(weights), joined[order]
    levels.append(is_leaf)
    chosen = 2 * len(weights) - 2
    for is_leaf in reversed(levels):
        taken = int(is_leaf[:chosen].sum())
        lengths[leaves[:taken]] += 1
        chosen = 2 * (chosen - taken)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then id; each is the next number at its length."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    code, previous = 0, 0
    for number in order.tolist():
        length = int(lengths[number])
        code <<= length - previous
        codes[number] = code
        code, previous = code + 1, length
    return codes


def decode_table(lengths: np.ndarray) -> np.ndarray:
    """For every value of the next 20 bits: id and code length, as id * 32 + length."""
    codes, table = canonical_codes(lengths), np.zeros(1 << LONGEST_CODE, np.int64)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(codes[used] << (LONGEST_CODE - lengths[used].astype(np.uint64)), kind="stable")]
    spans = 1 << (LONGEST_CODE - lengths[order].astype(np.int64))
    filled = np.repeat(order * 32 + lengths[order], spans)
    table[: len(filled)] = filled
    return table


def pack_ids(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' codes one after the other, and the bit offset of every block."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    total = int(ends[-1]) if len(ids) else 0
    words = np.zeros(total // 64 + 2, np.uint64)
    word, bit = starts >> 6, starts & 63
    room = 64 - bit - size
    code = codes[ids]
    high = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
    if len(ids):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        words[word[first]] = np.bitwise_or.reduceat(high, first)
        over = np.flatnonzero(room < 0)
        words[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
    return words.astype(">u8").tobytes(), starts[::BLOCK_IDS]


def unpack_ids(bits: bytes, checkpoints: np.ndarray, count: int, table: np.ndarray) -> np.ndarray:
    """All ids of a segment: the k-th id of every block is looked up at once."""
    words = np.frombuffer(bits, ">u8").astype(np.uint64)
    blocks = len(checkpoints)
    out = np.empty((BLOCK_IDS, blocks), np.int32)
    at = checkpoints.astype(np.int64).copy()
    last = count - BLOCK_IDS * (blocks - 1)
    shift = np.uint64(64 - LONGEST_CODE)
    for k in range(BLOCK_IDS if blocks > 1 else last):
        if k == last:
            at = at[:-1]
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        # Shifting by 64 is undefined, so the next word is shifted in two steps.
        window = (words[word] << bit) | (words[word + 1] >> np.uint64(1) >> (np.uint64(63) - bit))
        entry = table[(window >> shift).astype(np.int64)]
        out[k, : len(at)] = entry >> 5
        at += entry & 31
    return out.T.reshape(-1)[:count]


def _id_table(docs: DataFrame, path: str, end: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        kind = encoder.kind
        tail = np.array([end], kind).tobytes()
        for ids, texts in column_rows(batches, "doc_id", "text"):
            raw = [r + tail for r in encoder.encode([t or "" for t in texts])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(raw, pa.binary()),
                 pa.array([np.dtype(kind).itemsize] * len(raw), pa.int32())],
                ["doc_id", "ids", "width"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, ids binary, width int"
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        if batch.num_rows:
            kind = "<u2" if batch.column(1)[0].as_py() == 2 else "<u4"
            found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            if len(found) > len(counts):
                found, counts = counts, found
            counts[: len(found)] += found
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["id", "n"])


def write_ids(docs: DataFrame, folder: str, path: str, end: int = 0) -> None:
    """Encode the texts, append ``end`` to each, and write ``folder``/codes and ``folder``/segments."""
    spark = docs.sparkSession
    ship(spark)
    ids = stored(_id_table(docs, path, end), "ids")
    # One row for each id that occurs: the vocabulary bounds what reaches the driver.
    counted = ids.select("ids", "width").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 + max((r.id for r in counted), default=0), np.int64)
    for row in counted:
        counts[row.id] = row.n
    lengths = code_lengths(counts)
    spark.createDataFrame([(bytes(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{folder}/codes")
    shared = spark.sparkContext.broadcast(lengths)  # a byte for each id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = shared.value
        codes = canonical_codes(lengths)
        segment, names, raw, held = 0, [], [], 0

        def close():
            sizes = [len(r) // width for r in raw]
            bits, checkpoints = pack_ids(np.frombuffer(b"".join(raw), kind), codes, lengths)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([names], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([bits], pa.large_binary()).cast(pa.binary()),
                 pa.array([checkpoints.tolist()], pa.list_(pa.int64()))],
                ["part", "segment", "doc_ids", "n_tokens", "bits", "checkpoints"],
            )

        for parts, doc_ids, texts, widths in column_rows(batches, "part", "doc_id", "ids", "width"):
            for part, doc_id, ids, width in zip(parts, doc_ids, texts, widths):
                kind = "<u2" if width == 2 else "<u4"
                names.append(doc_id)
                raw.append(ids)
                held += len(ids) // width
                if held >= SEGMENT_IDS:
                    yield close()
                    segment, names, raw, held = segment + 1, [], [], 0
        if names:
            yield close()

    (
        ids.repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "ids")
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(
            run, "part int, segment int, doc_ids array<long>, n_tokens array<long>, bits binary, checkpoints array<long>"
        )
        .write.parquet(f"{folder}/segments")
    )


def read_ids(spark, folder: str, reduce, schema: str) -> DataFrame:
    """Decode every segment; ``reduce(ids)`` makes the columns of ``schema`` of each document's ids.

    Returns part, segment, place, doc_id, n_tokens and these columns.
    """
    ship(spark)
    lengths = spark.read.schema("lengths binary").parquet(f"{folder}/codes").first().lengths
    shared = spark.sparkContext.broadcast(lengths)
    names = [field.split()[0] for field in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(np.frombuffer(shared.value, np.uint8))
        for batch in batches:
            for row in range(batch.num_rows):
                part, segment, doc_ids, sizes, bits, checkpoints = (batch.column(c)[row].as_py() for c in range(6))
                ids = unpack_ids(bits, np.array(checkpoints, np.int64), sum(sizes), table)
                ends = np.cumsum(sizes)
                made = [reduce(ids[e - n : e]) for e, n in zip(ends.tolist(), sizes)]
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([part] * len(sizes), pa.int32()), "segment": pa.array([segment] * len(sizes), pa.int32()),
                     "place": pa.array(range(len(sizes)), pa.int32()), "doc_id": pa.array(doc_ids, pa.int64()),
                     "n_tokens": pa.array(sizes, pa.int64()), "before": pa.array((ends - sizes).tolist(), pa.int64())}
                    | {n: pa.array([m[k] for m in made]) for k, n in enumerate(names)}
                )

    segments = spark.read.schema(
        "part int, segment int, doc_ids array<long>, n_tokens array<long>, bits binary, checkpoints array<long>"
    ).parquet(f"{folder}/segments")
    return segments.mapInArrow(
        run, f"part int, segment int, place int, doc_id long, n_tokens long, before long, {schema}"
    )


def read_digests(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""

    def crc(ids: np.ndarray) -> tuple[int]:
        return (zlib.crc32(ids.astype("<u4").tobytes()),)

    rows = read_ids(spark, folder, crc, "ids_crc32 long")
    sizes = (
        spark.read.schema("part int, segment int, n_tokens array<long>").parquet(f"{folder}/segments")
        .select("part", "segment", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    )
    # A running sum within each part, and one over a row for each part.
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("base"))
    offsets = (
        sizes.withColumn("offset", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(F.broadcast(parts), "part")
        .select("part", "segment", (F.col("base") + F.col("offset")).alias("first"))
    )
    return rows.join(offsets, ["part", "segment"]).select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, path: str, end: int = 0) -> DataFrame:
    """Write the ids of ``docs`` to a new folder and read them back."""
    folder = scratch(docs.sparkSession, "token-files")
    write_ids(docs, folder, path, end)
    return read_digests(docs.sparkSession, folder)
