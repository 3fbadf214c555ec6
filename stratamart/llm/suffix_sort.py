"""Sorting the suffixes of one task's strings by blocks, with a difference cover.

A difference cover of v is a set of residues such that for any two positions some shift below v takes
both into the set. Positions with such residues are sampled, and ranked once by the text that follows,
doubling the length compared. Suffixes are then sorted one bucket of first bytes at a time: to a depth
of v by their bytes, and where they still tie, by the ranks of the sampled positions that the shift of the
pair leads to. So memory is that of the text, the sample and one bucket, however long suffixes agree.
"""

from __future__ import annotations

import numpy as np

PERIOD = 32
BUCKET = 1 << 18
_GAP = 16
_END = 0xFF  # not a byte of UTF-8


def difference_cover(period: int) -> tuple[np.ndarray, np.ndarray]:
    """Residues of a cover, found greedily, and for every difference d a shift s with s and s + d in it."""
    cover = [0]
    met = {0}
    while len(met) < period:
        gain = {c: {(c - x) % period for x in cover} | {(x - c) % period for x in cover} for c in range(period)}
        best = max(range(period), key=lambda c: (len(gain[c] - met), -c))
        met |= gain[best]
        cover.append(best)
    shift = np.zeros(period, np.int64)
    for d in range(period):
        shift[d] = min(s for s in range(period) if s in cover and (s + d) % period in cover)
    return np.sort(np.array(cover)), shift


_COVER, _SHIFT = difference_cover(PERIOD)
_SAMPLED = np.isin(np.arange(PERIOD), _COVER)


def _names(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of keys."""
    order = np.argsort(keys, kind="stable")
    found = keys[order]
    step = np.zeros(len(keys), np.uint64)
    step[1:] = found[1:] != found[:-1]
    out = np.empty(len(keys), np.uint64)
    out[order] = np.cumsum(step)
    return out


class SuffixSorter:
    """Strings laid end to end, with what compares their suffixes up to ``depth`` bytes or more."""

    def __init__(self, strings: list[bytes], depth: int):
        self.depth = depth
        lengths = np.array([len(s) for s in strings], np.int64)
        self.bases = np.concatenate(([0], np.cumsum(lengths + _GAP)))[:-1]
        text = bytes([_END] * _GAP).join(strings) + bytes([_END] * (_GAP + PERIOD + 8))
        narrow = np.frombuffer(text, np.uint8).astype(np.uint64)
        n = len(narrow) - 7
        two = narrow[:-1] << np.uint64(8) | narrow[1:]
        four = two[:-2] << np.uint64(16) | two[2:]
        # The eight bytes at every position, most significant first.
        self.eight = (four[:-4] << np.uint64(32) | four[4:])[:n]
        self.ranks, self.place = self._ranked()

    def _ranked(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.eight) - PERIOD + 8
        at = np.flatnonzero(_SAMPLED[np.arange(n) % PERIOD])
        place = np.full(n + PERIOD, -1, np.int64)
        place[at] = np.arange(len(at))
        names = _names(self.eight[at])
        for offset in range(8, PERIOD, 8):
            names = _names(names << np.uint64(32) | _names(self.eight[at + offset]))
        length = PERIOD
        while length < self.depth and len(names) and int(names.max()) < len(names) - 1:
            onward = at + length
            beyond = np.where(onward < n, place[np.minimum(onward, n)], -1)
            follow = np.where(beyond >= 0, names[beyond] + np.uint64(1), np.uint64(0))
            names = _names(names << np.uint64(32) | follow)
            length *= 2
        return names, place

    def buckets(self, suffixes: np.ndarray, size: int = BUCKET):
        """Suffixes by ranges of their first eight bytes, about ``size`` in each."""
        first = self.eight[suffixes]
        count = -(-len(suffixes) // size)
        if count < 2:
            yield suffixes
            return
        some = np.sort(first[:: max(1, len(first) // (64 * count))])
        cuts = np.unique(some[np.arange(1, count) * len(some) // count])
        bucket = np.searchsorted(cuts, first, side="right")
        for k in range(len(cuts) + 1):
            yield suffixes[bucket == k]

    def sort(self, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, and for each whether it shares its first bytes, up to the period, with the one before."""
        order = suffixes[np.argsort(self.eight[suffixes], kind="stable")]
        tied = np.zeros(len(order), bool)
        tied[1:] = self.eight[order[1:]] == self.eight[order[:-1]]
        for offset in range(8, PERIOD, 8):
            at = self._active(tied)
            if not len(at):
                return order, tied
            group = np.cumsum(~tied)[at]
            keys = self.eight[order[at] + offset]
            by = np.lexsort((keys, group))
            order[at] = order[at][by]
            keys, group = keys[by], group[by]
            same = np.zeros(len(at), bool)
            same[1:] = (keys[1:] == keys[:-1]) & (group[1:] == group[:-1])
            tied[at] = same
        shallow = tied.copy()
        self._resolve(order, tied)
        return order, shallow

    @staticmethod
    def _active(tied: np.ndarray) -> np.ndarray:
        """Places of suffixes that tie with the one before or after."""
        out = tied.copy()
        out[:-1] |= tied[1:]
        return np.flatnonzero(out)

    def _resolve(self, order: np.ndarray, tied: np.ndarray) -> None:
        """Put tied suffixes in order: all groups of ties are split at once, each by one of its members."""
        at = self._active(tied)
        group = np.cumsum(~tied)[at]
        while len(at):
            own = order[at]
            starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(at)])))
            pivot = np.repeat(own[starts + sizes // 2], sizes)
            shift = (_SHIFT[(own - pivot) % PERIOD] - pivot) % PERIOD
            mine, theirs = self.ranks[self.place[own + shift]], self.ranks[self.place[pivot + shift]]
            side = 1 + (mine > theirs).astype(np.int64) - (mine < theirs)
            key = np.repeat(np.arange(len(starts)), sizes) * 3 + side
            by = np.argsort(key, kind="stable")
            order[at] = own[by]
            key = key[by]
            # What equals its pivot is placed; a part of one is too.
            edges = np.concatenate(([True], key[1:] != key[:-1], [True]))
            alone = edges[:-1] & edges[1:]
            left = (key % 3 != 1) & ~alone
            at, group = at[left], key[left]


def repeated_windows(strings: list[bytes], counts: list[int], length: int, bucket: int = BUCKET) -> list[np.ndarray]:
    """For the first ``counts`` starts of each string, whether the ``length`` bytes there start at another of them too."""
    if not strings:
        return []
    sorter = SuffixSorter(strings, length)
    counts = np.asarray(counts, np.int64)
    ends = np.cumsum(counts)
    suffixes = np.arange(ends[-1]) - np.repeat(ends - counts, counts) + np.repeat(sorter.bases, counts)
    repeated = np.zeros(len(sorter.eight), bool)
    for some in sorter.buckets(suffixes, bucket):
        order, shallow = sorter.sort(some)
        pair = np.flatnonzero(shallow) if length >= PERIOD else np.arange(1, len(order))
        for offset in [*range(0, length - 7, 8), length - 8]:
            pair = pair[sorter.eight[order[pair] + offset] == sorter.eight[order[pair - 1] + offset]]
        repeated[order[pair]] = True
        repeated[order[pair - 1]] = True
    return [repeated[b : b + c] for b, c in zip(sorter.bases, counts, strict=True)]
