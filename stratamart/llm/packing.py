"""Packing of tokenised documents into training sequences, over several context lengths.

Every task tokenises its share of the documents and packs it, so nothing is shuffled and no task
waits for another. A task holds a pool of some million tokens. Documents of at least the longest
context are cut into full sequences; what is left of them, and every shorter document, is routed
to the shortest tier (context length) that holds it. Tiers are packed from the longest down: a
sequence starts with its tier's longest document, its gap takes the longest documents of this and
the shorter tiers that fit, and a last gap is closed by cutting the longest document left. So all sequences are
full; only the one at the end of a task may stay open, and is padded to the longest context.
Sequences are then dealt to step groups of about equal token counts, longest first.
"""

from __future__ import annotations

import bisect
import heapq
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 32 * 2048
POOL_TOKENS = 1 << 20
END_OF_TEXT = 1

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long"
)

# White space other than single spaces and line breaks, and the one special token.
_ODD = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\v", "\f", "\x1c", "\x1d", "\x1e", "\x1f", "<|endoftext|>")
_ODD_WIDE = tuple("\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
_CACHED_WORDS = 400_000
_encoders: dict[str, WordEncoder] = {}


class _Known(dict):
    """Ids of words met so far; a new one is encoded when it is asked for."""

    def __init__(self, encoder: WordEncoder, before: str):
        self.encoder, self.before = encoder, before

    def __missing__(self, word: str) -> bytes:
        if len(self) > _CACHED_WORDS:
            self.clear()
        core = word.rstrip(".,")
        if not core.isalpha():
            ids = self.encoder.ids(self.before + word)
        elif len(core) < len(word):
            ids = self[core] + self.encoder.tail(word[len(core) :])
        else:
            ids = self.encoder.letters(core, self.before)
        self[word] = ids
        return ids


class WordEncoder:
    """Ids of texts as little-endian 32-bit integers, encoding each distinct word once.

    The tokenizer cuts text before a single space and around a single line break before it merges
    anything, so a text without other white space is the concatenation of its words' ids. A word
    of letters only is one unit to the tokenizer and goes straight to its merge model. Any other
    text is given to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._merge = self._tokenizer.model.tokenize
        self._packed = [k.to_bytes(4, "little") for k in range(self._tokenizer.get_vocab_size())]
        # The character that byte-level vocabularies show for each byte: itself where it is printable.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self._shown = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self._first, self._later = _Known(self, ""), _Known(self, " ")
        self._tails: dict[str, bytes] = {}
        self._break = self.ids("\n")

    def ids(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([self._packed[k] for k in ids])

    def tail(self, marks: str) -> bytes:
        if marks not in self._tails:
            if len(self._tails) > _CACHED_WORDS:
                self._tails.clear()
            self._tails[marks] = self.ids(marks)
        return self._tails[marks]

    def letters(self, word: str, before: str) -> bytes:
        shown = self._shown
        text = "".join([shown[b] for b in (before + word).encode()])
        return b"".join([self._packed[t.id] for t in self._merge(text)])

    def encode(self, text: str) -> bytes:
        if any(x in text for x in _ODD) or not text.isascii() and any(x in text for x in _ODD_WIDE):
            return self.ids(text)
        first, later = self._first.__getitem__, self._later.__getitem__
        lines = []
        for line in text.split("\n"):
            head, *parts = line.split(" ")
            lines.append(first(head) + b"".join(map(later, parts)))
        return self._break.join(lines)


class Packer:
    """Packs one task's documents; pieces are (document, start, length)."""

    def __init__(self, tiers: tuple[int, ...], step_tokens: int):
        self.tiers, self.step_tokens = tuple(sorted(tiers)), step_tokens
        # Per tier, pieces not yet placed, ascending by length.
        self.waiting: list[list[tuple[int, int, int]]] = [[] for _ in self.tiers]
        self.tokens = [0] * len(self.tiers)
        self.done: list[tuple[int, list[tuple[int, int, int]]]] = []

    def add(self, doc: int, tokens: int) -> None:
        longest = self.tiers[-1]
        for start in range(0, tokens - longest + 1, longest):
            self.done.append((longest, [(longest, doc, start)]))
        left = tokens % longest
        if left:
            self._route(left, doc, tokens - left)

    def _route(self, length: int, doc: int, start: int) -> None:
        k = bisect.bisect_left(self.tiers, length)
        bisect.insort(self.waiting[k], (length, doc, start))
        self.tokens[k] += length

    def _pop(self, k: int, at: int) -> tuple[int, int, int]:
        piece = self.waiting[k].pop(at)
        self.tokens[k] -= piece[0]
        return piece

    def _best(self, gap: int, k: int) -> tuple[int, int, int] | None:
        """Take the longest piece of tier ``k`` or a shorter one that fits the gap."""
        for j in range(k, -1, -1):
            at = bisect.bisect_right(self.waiting[j], (gap, 1 << 62, 1 << 62))
            if at:
                return self._pop(j, at - 1)
        return None

    def _longest(self, k: int) -> tuple[int, int, int] | None:
        for j in range(k, -1, -1):
            if self.waiting[j]:
                return self._pop(j, -1)
        return None

    def pack(self, last: bool) -> None:
        """Close all sequences that can be filled; with ``last`` the rest too."""
        for k in range(len(self.tiers) - 1, -1, -1):
            size = self.tiers[k]
            while self.waiting[k]:
                if not last and sum(self.tokens[: k + 1]) < size:
                    break
                held, gap = [], size
                while gap and (piece := self._best(gap, k)):
                    held.append(piece)
                    gap -= piece[0]
                if gap and (piece := self._longest(k)):
                    length, doc, start = piece
                    held.append((gap, doc, start))
                    self._route(length - gap, doc, start + gap)
                    gap = 0
                # What cannot be filled is padded to the longest context.
                self.done.append((size if not gap else self.tiers[-1], held))

    def take(self) -> list[tuple[int, int, list[tuple[int, int, int]]]]:
        """Finished sequences as (step group, tier, pieces), groups of about equal token counts."""
        total = sum(p[0] for _, held in self.done for p in held)
        loads = [(0, g) for g in range(max(1, round(total / self.step_tokens)))]
        out = []
        for size, held in sorted(self.done, key=lambda x: -x[0]):
            load, group = heapq.heappop(loads)
            heapq.heappush(loads, (load + sum(p[0] for p in held), group))
            out.append((group, size, held))
        self.done = []
        return out


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    pool_tokens: int = POOL_TOKENS,
) -> DataFrame:
    """One row per piece of a document: its token range, and its place in a sequence.

    ``tokenizer`` is the path of a tokenizer file that every executor has. A document is its ids
    and then the id 1, so a null or empty text has one token. Repeated rows, also of one doc_id,
    are packed each; null doc_ids are kept. A text of any length is tokenised whole. An empty
    table gives no rows. Columns other than doc_id and text are ignored. ``sequence_id`` and
    ``step_group`` are unique across the tasks of one job, not dense.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.setdefault(tokenizer, None) or WordEncoder(tokenizer)
        _encoders[tokenizer] = encoder
        place = TaskContext.get().partitionId() << 32
        packer = Packer(tiers, step_tokens)
        held: dict[int, tuple[int | None, bytes]] = {}
        number = sequence = group = pooled = 0

        def emit(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, group
            packer.pack(last)
            rows: list[list] = [[] for _ in range(9)]
            groups = 0
            for step, tier, pieces in packer.take():
                offset, groups = 0, max(groups, step + 1)
                for length, doc, start in pieces:
                    doc_id, ids = held[doc]
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                    row = (doc_id, start, length, crc, len(ids) // 4, place + sequence, offset, tier, place + group + step)
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
                    offset += length
                sequence += 1
            group += groups
            waiting = {p[1] for tier in packer.waiting for p in tier}
            for doc in held.keys() - waiting:
                del held[doc]
            if rows[0]:
                kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
                names = [x.split()[0] for x in SCHEMA.split(", ")]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)

        end = np.asarray([END_OF_TEXT], "<u4").tobytes()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = encoder.encode(text.as_py() or "") + end
                held[number] = (doc_id.as_py(), ids)
                packer.add(number, len(ids) // 4)
                pooled += len(ids) // 4
                number += 1
                if pooled >= pool_tokens:
                    yield from emit(last=False)
                    pooled = 0
        yield from emit(last=True)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
