"""Elias-Fano sequences and the n-gram trie made of them."""

from __future__ import annotations

import struct

import numpy as np

_SELECT = np.full((256, 9), 8, np.uint8)  # place of the k-th zero of a byte
for _byte in range(256):
    for _rank, _place in enumerate([p for p in range(8) if not _byte >> p & 1]):
        _SELECT[_byte, _rank] = _place
_ZEROS = np.array([8 - bin(b).count("1") for b in range(256)], np.uint8)


class EliasFano:
    """A sorted sequence of unsigned 64-bit numbers: low bits packed, high bits in unary.

    The k-th number's high bits h are the one at place h + k; a bucket's numbers stand between two zeros.
    """

    def __init__(self, count: int, low_bits: int, lows: np.ndarray, highs: np.ndarray):
        self.count, self.low_bits, self.lows, self.highs = count, low_bits, lows, highs
        zeros = _ZEROS[self.highs]
        self.zeros_before = np.concatenate([[0], np.cumsum(zeros, dtype=np.int64)])

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        count = len(values)
        largest = int(values[-1]) if count else 0
        low_bits = max(0, (largest // max(1, count)).bit_length() - 1)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(count)
        bits = np.zeros((int(places[-1]) if count else 0) + 10, np.uint8)
        bits[places] = 1
        low = values & np.uint64((1 << low_bits) - 1)
        words = np.zeros(count * low_bits // 64 + 2, np.uint64)
        start = np.arange(count, dtype=np.int64) * low_bits
        word, shift = start >> 6, (start & 63).astype(np.uint64)
        if count and low_bits:
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            words[word[first]] = np.bitwise_or.reduceat(low << shift, first)
            over = np.flatnonzero(shift.astype(np.int64) + low_bits > 64)
            np.bitwise_or.at(words, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        return cls(count, low_bits, words, np.packbits(bits, bitorder="little"))

    def low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), np.uint64)
        start = index * self.low_bits
        word, shift = start >> 6, (start & 63).astype(np.uint64)
        # Shifting by 64 is undefined, so the next word is shifted in two steps.
        value = (self.lows[word] >> shift) | (self.lows[word + 1] << np.uint64(1) << (np.uint64(63) - shift))
        return value & np.uint64((1 << self.low_bits) - 1)

    def bucket_starts(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have high bits below ``high``: the place of the ``high``-th zero less the zeros."""
        high = np.minimum(high, self.zeros_before[-1])
        byte = np.searchsorted(self.zeros_before, high, side="left") - 1
        byte = np.maximum(byte, 0)
        rank = high - self.zeros_before[byte] - 1
        place = byte * 8 + _SELECT[self.highs[byte], np.maximum(rank, 0)]
        return np.where(high > 0, place + 1 - high, 0)

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value, the index of the first number not below it, and whether it is equal."""
        values = np.asarray(values, np.uint64)
        wanted_low = values & np.uint64((1 << self.low_bits) - 1)
        high = np.minimum(values >> np.uint64(self.low_bits), np.uint64(1 << 62)).astype(np.int64)
        at, end = self.bucket_starts(high), self.bucket_starts(high + 1)
        at, end = np.minimum(at, self.count), np.minimum(end, self.count)
        equal = np.zeros(len(values), bool)
        # Halve each value's stretch of its bucket until it is empty.
        top, open_ = end.copy(), np.flatnonzero(at < end)
        while len(open_):
            middle = (at[open_] + top[open_]) >> 1
            below = self.low(middle) < wanted_low[open_]
            at[open_[below]] = middle[below] + 1
            top[open_[~below]] = middle[~below]
            open_ = open_[at[open_] < top[open_]]
        inside = np.flatnonzero(at < end)
        equal[inside] = self.low(at[inside]) == wanted_low[inside]
        return at, equal

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        """The numbers at these indices."""
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.count]
        return ((ones[index] - index).astype(np.uint64) << np.uint64(self.low_bits)) | self.low(np.asarray(index))

    def dump(self) -> bytes:
        lows, highs = self.lows.tobytes(), self.highs.tobytes()
        highs += b"\0" * (-len(highs) % 8)
        return struct.pack("<4q", self.count, self.low_bits, len(lows), len(self.highs)) + lows + highs

    @classmethod
    def load(cls, buffer, start: int) -> tuple[EliasFano, int]:
        """A sequence that views ``buffer`` (bytes or a memory map), and the place behind it."""
        count, low_bits, lows, highs = struct.unpack_from("<4q", buffer, start)
        start += 32
        low = np.frombuffer(buffer, "<u8", lows // 8, start)
        high = np.frombuffer(buffer, np.uint8, highs, start + lows)
        return cls(count, low_bits, low, high), start + lows + highs + -highs % 8


LEAST_LOG = -8.0
STEP = LEAST_LOG / 254


def quantised(probability: np.ndarray) -> np.ndarray:
    """Codes 1 to 255 of the decimal logarithm between 0 and -8; 0 stands for no probability."""
    with np.errstate(divide="ignore"):
        codes = np.rint(np.log10(probability) / STEP) + 1
    return np.where(probability > 0, np.clip(codes, 1, 255), 0).astype(np.uint8)


def dequantised(codes: np.ndarray) -> np.ndarray:
    table = 10.0 ** (STEP * (np.arange(256) - 1.0))
    table[0] = 0
    return table[codes]


class NgramTrie:
    """Contexts and their successors in two levels.

    Level one: sorted context hashes, and monotone pointers to where each one's successors begin. Level two: the
    successors' 32-bit marks, sorted within their context and made monotone by the context's number, with one
    byte each for the discounted probability. That key replaces the pointers in ``lookup``, which does not read
    them. ``open`` maps a file that ``dump`` made.
    """

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.successors, self.codes = contexts, pointers, successors, codes

    @classmethod
    def build(cls, contexts: np.ndarray, context_counts: np.ndarray, keys: np.ndarray, counts: np.ndarray, discount: float) -> NgramTrie:
        """``keys``: sorted, the context's number times 2^32 plus the successor's mark; counts are above 0."""
        number = (keys >> np.uint64(32)).astype(np.int64)
        begins = np.searchsorted(number, np.arange(len(contexts) + 1))
        probability = (counts - discount) / context_counts[number]
        return cls(EliasFano.of(contexts), EliasFano.of(begins), EliasFano.of(keys), quantised(probability))

    def lookup(self, contexts: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Codes of (context hash, successor mark); 0 where the pair is unknown."""
        number, known = self.contexts.successor(contexts)
        at, equal = self.successors.successor((number.astype(np.uint64) << np.uint64(32)) | marks.astype(np.uint64))
        found = known & equal
        return np.where(found, self.codes[np.where(found, at, 0)] if len(self.codes) else 0, 0).astype(np.uint8)

    def dump(self) -> bytes:
        return b"".join(s.dump() for s in (self.contexts, self.pointers, self.successors)) + self.codes.tobytes()

    @classmethod
    def load(cls, buffer) -> NgramTrie:
        levels, at = [], 0
        for _ in range(3):
            level, at = EliasFano.load(buffer, at)
            levels.append(level)
        return cls(*levels, np.frombuffer(buffer, np.uint8, levels[2].count, at))

    @classmethod
    def open(cls, path: str) -> NgramTrie:
        return cls.load(np.memmap(path, np.uint8, "r"))
