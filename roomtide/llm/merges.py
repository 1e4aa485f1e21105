"""Byte-pair merges of many words at once: every round merges one pair of each word.

The words of a chunk stand side by side in columns, their symbols in rows; links tell which rows of a column are
left. A round takes each column's pair of lowest rank, the leftmost first, as merging word by word does.
"""

from __future__ import annotations

import numpy as np

LONGEST_WORD = 32  # in bytes; places in a word are kept in so many numbers
CHUNK_WORDS = 4096
NO_RANK = np.iinfo(np.int32).max
RANK_BITS = 24
MIXER = np.uint64(0x9E3779B97F4A7C15)


class Merges:
    """The merges of a vocabulary: ``pairs`` of ids by rank, ``merged`` ids, and the id of each byte."""

    def __init__(self, pairs: np.ndarray, merged: np.ndarray, byte_ids: np.ndarray, size: int):
        self.merged, self.byte_ids = merged.astype(np.int64), byte_ids.astype(np.int64)
        self.none = size  # stands before and behind a word; no pair has it
        keys = pairs[:, 0].astype(np.int64) * (size + 1) + pairs[:, 1]
        bits = max(10, 2 + int(len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        # An open table of pair and rank; a pair lies at its own place or behind it, with no free place between.
        self.table = np.full(1 << bits, -1, np.int64)
        entries, place = keys << RANK_BITS | np.arange(len(keys)), self._place(keys)
        while len(entries):
            free = self.table[place] < 0
            self.table[place[free]] = entries[free]
            left = self.table[place] != entries
            entries, place = entries[left], place[left] + 1 & self.mask
        every = np.arange(256)
        self.first = self._ranks(*(self.byte_ids[x].ravel() for x in np.meshgrid(every, every, indexing="ij")))

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MIXER) >> self.shift).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, each times ``LONGEST_WORD`` to leave room for a place."""
        keys = left * (self.none + 1) + right
        place = self._place(keys)
        found = self.table[place]
        unsettled = np.flatnonzero((found >> RANK_BITS != keys) & (found >= 0))
        while len(unsettled):
            place[unsettled] = place[unsettled] + 1 & self.mask
            found[unsettled] = now = self.table[place[unsettled]]
            unsettled = unsettled[(now >> RANK_BITS != keys[unsettled]) & (now >= 0)]
        return np.where(found >= 0, (found & (1 << RANK_BITS) - 1) * LONGEST_WORD, NO_RANK).astype(np.int32)

    def _chunk(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that lie in the columns of ``raw``, word by word, and how many each has."""
        longest, n = raw.shape
        rows = np.arange(longest)[:, None]
        inside = rows < sizes
        ids = np.full((longest + 1, n), self.none, np.int64)
        ids[:-1][inside] = self.byte_ids[raw[inside]]
        ranks = np.full((longest + 1, n), NO_RANK, np.int32)
        paired = rows[:-1] + 1 < sizes
        found = self.first[raw[:-1].astype(np.int64) << 8 | raw[1:]]
        ranks[:-2] = np.where(paired & (found != NO_RANK), found + rows[:-1].astype(np.int32), NO_RANK)
        after = np.repeat(rows + 1, n, axis=1)
        after = np.where(after < sizes, after, longest)
        before = np.repeat(np.r_[longest, rows[:, 0]][:, None], n, axis=1)
        flat_ids, flat_ranks, flat_after, flat_before = ids.ravel(), ranks.ravel(), after.ravel(), before.ravel()
        while True:
            lowest = ranks.min(axis=0)
            column = np.flatnonzero(lowest != NO_RANK)
            if not len(column):
                break
            lowest = lowest[column].astype(np.int64)
            place = lowest % LONGEST_WORD
            at = place * n + column
            gone = flat_after[at] * n + column
            following = flat_after[gone]
            follower, leading = following * n + column, flat_before[at]
            leader = leading * n + column
            new = self.merged[lowest // LONGEST_WORD]
            flat_ids[at], flat_ids[gone] = new, -1
            flat_after[at], flat_before[follower], flat_ranks[gone] = following, place, NO_RANK
            found = self._ranks(new, flat_ids[follower])
            flat_ranks[at] = np.where(found == NO_RANK, NO_RANK, found + place)
            found = self._ranks(flat_ids[leader], new)
            flat_ranks[leader] = np.where(found == NO_RANK, NO_RANK, found + leading)
        ids = ids[:-1].T
        kept = (ids >= 0) & (ids != self.none)
        return ids[kept], kept.sum(axis=1)

    def __call__(self, raw: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words of up to ``LONGEST_WORD`` bytes: all of them in one array, and each word's start and count.

        ``raw`` holds the words' bytes and ``LONGEST_WORD`` more.
        """
        starts, counts = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        parts, done = [np.zeros(0, np.int64)], 0
        order = np.argsort(sizes, kind="stable")
        order = order[np.searchsorted(sizes[order], 1) :]
        for k in range(0, len(order), CHUNK_WORDS):
            chosen = order[k : k + CHUNK_WORDS]
            rows = np.arange(sizes[chosen[-1]])[:, None]
            ids, number = self._chunk(raw[begins[chosen] + rows], sizes[chosen])
            ends = done + np.cumsum(number)
            starts[chosen], counts[chosen] = ends - number, number
            parts.append(ids)
            done += len(ids)
        return np.concatenate(parts), starts, counts
