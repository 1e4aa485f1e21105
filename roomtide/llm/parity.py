"""Parity sketches of token sets, and the signatures by which similar sets must meet.

Every token falls, by its hash, on one bit of a document's sketch and flips it. One differing token changes
one bit at most, so the Hamming distance of two sketches is a lower bound of the symmetric difference of
their sets. Cut into parts, two sketches of sets that differ in at most d tokens agree in all parts but d.
A part stands for a great many bits; what is kept of it is the XOR of its tokens' hashes, which is equal
where the bits are equal.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import xxhash

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xBF58476D1CE4E5B9)
BAND_RATIO = 1.4
SPARE = 0.25


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * MIX2
    x = (x ^ (x >> np.uint64(27))) * MIX
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width`` consecutive words; of fewer words, one hash of the sequence.

    A-Z count as a-z; words end at space, tab, line feed, vertical tab, form feed and carriage return.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(width, len(words))
    rolled = hashes[: len(words) - span + 1] + np.uint64(span)
    for k in range(1, span):
        rolled = mixed(rolled) + hashes[k : len(words) - span + 1 + k]
    return np.unique(mixed(rolled))


def digest(tokens: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


class Bands:
    """Size bands for one threshold of ``percent`` (Jaccard similarity in hundredths)."""

    def __init__(self, percent: int, largest: int = 1 << 40):
        self.percent = percent
        self.starts = [1]
        while self.starts[-1] < largest:
            self.starts.append(max(self.starts[-1] + 1, int(self.starts[-1] * BAND_RATIO)))

    def most_apart(self, band: int) -> int:
        """The symmetric difference that linked sets can have if the larger one is of this band.

        |A n B| >= t |A u B| means |A ^ B| <= (1 - t) / (1 + t) (|A| + |B|), and |A| <= |B|.
        """
        return (100 - self.percent) * 2 * (self.starts[band + 1] - 1) // (100 + self.percent)

    def of(self, size: int) -> range:
        """The bands in which a set of this size may meet an equal or larger partner, its own first."""
        return range(bisect_right(self.starts, size) - 1, bisect_right(self.starts, size * 100 // self.percent))

    def signatures(self, tokens: np.ndarray) -> np.ndarray:
        """Hashes of which two linked, unequal sets have one in common at least.

        In a band whose pairs differ in d tokens at most, the sketch has d + 1 + r parts, so a pair agrees
        in r + 1. Each set gives its d + 1 fullest parts (by token count, then XOR). The fullest part on which
        a pair agrees is outranked in either set by differing parts only, at most d; so both give it.
        """
        found = []
        for band in self.of(len(tokens)):
            apart = self.most_apart(band)
            if apart < 1:  # only equal sets link
                continue
            parts = apart + 1 + max(1, int((apart + 1) * SPARE))
            part = ((mixed(tokens + np.uint64(band + 1)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            filled = np.bincount(part, minlength=parts)
            starts = np.zeros(parts, np.int64)
            np.cumsum(filled[:-1], out=starts[1:])
            some = filled > 0
            sums = np.zeros(parts, np.uint64)
            sums[some] = np.bitwise_xor.reduceat(mixed(tokens ^ MIX)[order], starts[some])
            fullest = np.lexsort((sums, -filled))[: apart + 1]
            place = mixed(np.array([band + 1], np.uint64) * MIX + fullest.astype(np.uint64))
            found.append(mixed(sums[fullest] + place) ^ place)
        return np.concatenate(found) if found else np.empty(0, np.uint64)


@lru_cache(maxsize=8)
def bands(percent: int) -> Bands:
    return Bands(percent)


MOST_SKETCH_WORDS = 64


def dense_sketch(tokens: np.ndarray) -> np.ndarray:
    """The sketch itself, at least four bits for each token up to 4096 bits: each token flips one bit.

    Sizes are powers of two and places are remainders, so a longer sketch folds onto a shorter one by XOR;
    the bound holds for every size.
    """
    words = 1
    while words < MOST_SKETCH_WORDS and words * 16 < len(tokens):
        words *= 2
    place = mixed(tokens ^ MIX2) & np.uint64(words * 64 - 1)
    flips = np.bincount(place.astype(np.int64), minlength=words * 64) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view("<u8")


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    while len(sketch) > words:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def close_partners(sizes: np.ndarray, labels: np.ndarray, sketches: list[np.ndarray], percent: int, limit: int):
    """Pairs of places that no sketch rules out, under different labels: the ``limit`` nearest of each place.

    Yields (place, its partners, whether there are more).
    """
    words = min(map(len, sketches))
    matrix = np.stack([folded(s, words) for s in sketches])
    for place in range(len(sizes)):
        most = (100 - percent) * (sizes + sizes[place]) // (100 + percent)
        apart = np.bitwise_count(matrix ^ matrix[place]).sum(1, dtype=np.int64)
        open_ = (labels != labels[place]) & (apart <= most) & (np.abs(sizes - sizes[place]) <= most)
        partners = np.flatnonzero(open_)
        if len(partners) > limit:
            yield place, partners[np.argsort(apart[partners], kind="stable")[:limit]], True
        elif len(partners):
            yield place, partners, False
