"""Whole texts as byte arrays, and hashes of all their words computed at once.

Scans hand a task Arrow batches. ``text_blocks`` cuts a batch into runs of whole texts of a few
megabytes, so that the arrays made from a block stay small; one text longer than that is a block
of its own. ``words`` finds and hashes every word of a block with a fixed number of array passes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values end to end, and the offsets between them; nulls are empty."""
    values = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    held = values.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_blocks(
    batches: Iterable[pa.RecordBatch], text: str = "text", most: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of a block, the bytes of their texts, and the offsets between the texts."""
    for batch in batches:
        data, offsets = flat(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield (
                batch.slice(first, last - first),
                data[offsets[first] : offsets[last]],
                offsets[first : last + 1] - offsets[first],
            )
            first = last


def power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, ``n`` of each at least."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers; a bijection."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class RangeHash:
    """Hashes of any byte ranges of a block, from one running sum."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        up, self._down = power_table(n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:n], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of a block in order: byte ranges, the text each is in, hashes; words before each text."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


# Separators of the plain word class: space and the controls from tab to carriage return.
PLAIN = np.ones(256, bool)
PLAIN[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[ord("A") : ord("Z") + 1] += 32


def word_ranges(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes within single texts."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    begins = inside[1:-1] & ~inside[:-2]
    finishes = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges + 1]
    finishes[edges - 1] = inside[edges]
    return np.flatnonzero(begins), np.flatnonzero(finishes) + 1


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = PLAIN, fold: np.ndarray = LOWER) -> Words:
    """Words of all texts of a block; ``fold`` maps bytes before hashing."""
    starts, ends = word_ranges(data, offsets, is_word)
    hashes = RangeHash(fold[data]).of(starts, ends)
    first = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(starts, ends, doc, hashes, first)


def windows(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of every run of ``n`` words within a text."""
    total = len(w.hashes)
    if total < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(w.doc[: total - n + 1] == w.doc[n - 1 :])
    h = w.hashes[at]
    for k in range(1, n):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + w.hashes[at + k])
    return at, h
