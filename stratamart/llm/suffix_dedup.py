"""Removal of long byte strings that occur more than once, by blockwise suffix sorting.

Suffixes that agree for ``length`` bytes have to meet in one task. A window of that length is owned by
its anchor: the leftmost of its byte grams with the least hash. Equal windows have equal anchors at equal
places, so a window can only repeat among occurrences of its anchor. The windows of one
occurrence are a range; the bytes they span are its context. About one byte in 85 is an anchor.

1. Anchors are counted by hash; occurrences of those met once are done with.
2. Of the others, equal contexts are counted. Windows of a context met twice are all repeated.
3. One copy of each context whose anchor has several goes to a task that lays them end to end and
   sorts the suffixes that start its windows with a difference cover, a bucket at a time; equal neighbours are repeated windows.
4. Ranges of repeated windows are merged per document and cut out.

Counts are combined before they are shuffled. An anchor with very many contexts is split by the bytes that windows
at neighbouring places share, so that no task holds all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.columns import join_by_size
from stratamart.llm.suffix_sort import repeated_windows
from stratamart.llm.textblocks import RangeHash, flat, text_blocks
from stratamart.workspace import materialize

LENGTH = 200
BROADCAST_BYTES = 24 << 20
SCAN_BYTES = 1 << 20
SORT_BYTES = 1 << 20
# Contexts of one anchor beyond which they are split, and how many places of windows a split has.
HOT_CONTEXTS = 20_000
SPLIT_PLACES = 16

_OCCURRENCES = "key long, anchor long, context long, first int, last int, at int"


def _owners(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value of every run of ``width`` values."""
    values, places = hashes, np.arange(len(hashes), dtype=np.int32)
    have = 1
    while have < width:
        step = min(have, width - have)
        left = values[:-step] <= values[step:]
        places = np.where(left, places[:-step], places[step:])
        values = np.where(left, values[:-step], values[step:])
        have += step
    return places


def _anchors(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, context hash, first and last window, and anchor place, of every occurrence; ``starts``: windows to consider."""
    gram = max(2, length // 6)
    ranges = RangeHash(data)
    n = len(data) - gram + 1
    grams = ranges.of(np.arange(n), np.arange(gram, gram + n))
    owner = _owners(grams, length - gram + 1)[starts]
    edge = np.flatnonzero((owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    first, last = starts[np.concatenate(([0], edge))], starts[np.concatenate((edge, [len(starts)])) - 1]
    at = owner[np.concatenate(([0], edge))]
    return grams[at], ranges.of(first, last + length), first, last, at


def _scan(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, most=SCAN_BYTES):
            # A very long text is read in parts that overlap; which windows there are does not depend on it.
            for low in range(0, max(len(data), 1), 2 * SCAN_BYTES):
                part = data[low : low + 2 * SCAN_BYTES + length - 1]
                if len(part) < length:
                    continue
                starts = np.arange(low, low + len(part) - length + 1)
                doc = np.searchsorted(offsets, starts, side="right") - 1
                inside = starts + length <= offsets[doc + 1]
                starts, doc = starts[inside], doc[inside]
                if not len(starts):
                    continue
                anchor, context, first, last, at = _anchors(part, starts - low, length)
                doc = np.searchsorted(offsets, first + low, side="right") - 1
                base = offsets[doc] - low
                columns = [
                    rows.column("key").take(pa.array(doc)),
                    pa.array(anchor.view(np.int64)),
                    pa.array(context.view(np.int64)),
                    *(pa.array((x - base).astype(np.int32)) for x in (first, last, at)),
                ]
                yield pa.record_batch(columns, ["key", "anchor", "context", "first", "last", "at"])

    return run


def _contexts(length: int):
    """Bytes of the contexts asked for, by bucket; a split anchor gives a row for each group of window places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            keys, wanted = batch.column("key").to_pylist(), batch.column("wanted")
            out: list[list] = [[], [], [], [], []]
            held = 0
            for k, key in enumerate(keys):
                text = data[offsets[k] : offsets[k + 1]].tobytes()
                for w in wanted[k].as_py():
                    first, last, at = w["first"], w["last"], w["at"]
                    if w["hot"]:
                        parts = []
                        for high in range(at - (at - last) // SPLIT_PLACES * SPLIT_PLACES, first - 1, -SPLIT_PLACES):
                            core = text[high : high - SPLIT_PLACES + 1 + length]
                            digest = int.from_bytes(hashlib.blake2b(core, digest_size=8).digest(), "little", signed=True)
                            parts.append((digest ^ w["anchor"], max(first, high - SPLIT_PLACES + 1), min(last, high)))
                    else:
                        parts = [(w["anchor"], first, last)]
                    for bucket, low, high in parts:
                        row = (bucket, key, low, high - low + 1, text[low : high + length])
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                        held += high - low + length
                if held > 8 << 20:
                    yield _context_batch(out)
                    out, held = [[], [], [], [], []], 0
            if out[0]:
                yield _context_batch(out)

    return run


_CONTEXTS = "bucket long, key long, first int, windows int, bytes binary"


def _context_batch(out: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = [x.split()[0] for x in _CONTEXTS.split(", ")]
    return pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)


def _sorted_spans(length: int):
    """Byte spans of repeated windows; rows come in order of bucket, whole buckets are sorted together."""

    def solve(keys, firsts, counts, strings) -> pa.RecordBatch:
        out_keys, lows, highs = [], [], []
        for key, first, flags in zip(keys, firsts, repeated_windows(strings, counts, length), strict=True):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
            for low, high in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                out_keys.append(key)
                lows.append(first + low)
                highs.append(first + high - 1 + length)
        columns = [pa.array(out_keys, pa.int64()), pa.array(lows, pa.int32()), pa.array(highs, pa.int32())]
        return pa.record_batch(columns, ["key", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], []]
        size, current, before = 0, None, None
        for batch in batches:
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (bucket, *row[:2]) == before:
                    continue  # from an equal row, whose text has the same key
                before = (bucket, *row[:2])
                if bucket != current and size > SORT_BYTES:
                    yield solve(*held)
                    held, size = [[], [], [], []], 0
                current = bucket
                for column, value in zip(held, row, strict=True):
                    column.append(value)
                size += len(row[-1])
        if held[0]:
            yield solve(*held)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of each document merged to maximal runs, packed as pairs of integers."""
    for batch in batches:
        packed = []
        for spans in batch.column("spans"):
            pairs = spans.values
            low, high = pairs.field("low").to_numpy(), pairs.field("high").to_numpy()
            by = np.argsort(low, kind="stable")
            low, top = low[by], np.maximum.accumulate(high[by])
            new = np.concatenate(([True], low[1:] > top[:-1]))
            last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(low) - 1]))
            packed.append(np.stack([low[new], top[last]], axis=1).astype(np.int64).tobytes())
        yield pa.record_batch([batch.column("key"), pa.array(packed, pa.binary())], ["key", "spans"])


def _cut(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            sizes, removed, runs, digests, kept = [], [], [], [], []
            for k, packed in enumerate(batch.column("spans")):
                text = data[offsets[k] : offsets[k + 1]]
                spans = np.frombuffer(packed.as_py() or b"", np.int64).reshape(-1, 2)
                edges = [0, *spans.ravel().tolist(), len(text)]
                rest = b"".join(text[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True))
                sizes.append(len(text))
                removed.append(len(text) - len(rest))
                runs.append(len(spans))
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if keep_text else None)
            columns = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, removed, runs)), pa.array(digests)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                columns.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.record_batch(columns, names)

    return run


def without_repeats(docs: DataFrame, length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """Each row of docs without the bytes covered by a ``length``-byte string that also starts elsewhere.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 of the bytes left,
    and with ``keep_text`` those bytes (``kept``). Texts are UTF-8 bytes, null is empty; matches
    lie within one text, and are judged on the input: all occurrences go, the first too. A
    repeated row is another occurrence, so its text goes wherever it is long enough. Null and repeated
    doc_ids are kept apart by their texts. Texts shorter than ``length`` keep all. Other columns are ignored.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    found = materialize(texts.select("key", "text").mapInArrow(_scan(length), _OCCURRENCES), "anchors")

    # Stored before they are joined, as the planner splits a hot key only where both sides of a join come from a shuffle.
    repeated = materialize(found.groupBy("anchor").count().where("count > 1").select("anchor"), "repeated-anchors")
    met = materialize(found.join(repeated, "anchor"), "repeated")
    place = F.struct("key", "first", "last", "at").alias("place")
    contexts = met.select("anchor", "context", place).groupBy("anchor", "context").agg(
        F.count("*").alias("n"), F.min("place").alias("place")
    )
    contexts = materialize(contexts, "contexts")
    several = contexts.groupBy("anchor").agg(F.count("*").alias("contexts")).where("contexts > 1")
    several = materialize(several, "several-contexts")
    wanted = (
        contexts.join(several, "anchor")
        .select("place.*", "anchor", (F.col("contexts") > HOT_CONTEXTS).alias("hot"))
        .groupBy("key")
        .agg(F.collect_list(F.struct("first", "last", "at", "anchor", "hot")).alias("wanted"))
    )
    wanted = materialize(wanted, "wanted")
    asked = texts.select("key", "text").join(wanted, "key")
    pieces = asked.mapInArrow(_contexts(length), _CONTEXTS)
    pieces = pieces.repartition("bucket").sortWithinPartitions("bucket", "key", "first")
    sorted_spans = pieces.mapInArrow(_sorted_spans(length), "key long, low int, high int")

    twice = contexts.where("n > 1").select("anchor", "context")
    whole = met.join(twice, ["anchor", "context"]).select(
        "key", F.col("first").alias("low"), (F.col("last") + length).alias("high")
    )
    spans = (
        whole.union(sorted_spans)
        .groupBy("key")
        .agg(F.collect_set(F.struct("low", "high")).alias("spans"))
        .mapInArrow(_merged, "key long, spans binary")
    )
    spans = materialize(spans, "spans")
    marked = join_by_size(texts, spans, "key", "left", F.length("spans"), BROADCAST_BYTES)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return marked.select("doc_id", "text", "spans").mapInArrow(_cut(keep_text), schema + (", kept binary" if keep_text else ""))

