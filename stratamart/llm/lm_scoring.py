"""Stupid-backoff scores of documents, from n-gram counts of all documents.

Documents are dealt to blocks of some megabytes of text. A block counts its own distinct n-grams of
each order first, and sends them, in sorted runs, to the count table, which is partitioned by hash. A partition adds
up what all blocks sent, and answers each with the totals of the n-grams it asked about. A block then joins
the answers back to the n-grams of its texts and sums scores per document. So a frequent n-gram crosses the
network once per block, and a table partition is bounded by how many there are, which grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.textblocks import PLAIN, Words, mix, text_blocks, word_ranges, words

ORDER = 3
BACKOFF = 0.4
LEAST = 2
BLOCK_TEXT = 12 << 20
PARTITION_GRAMS = 1 << 20

_MIX = np.uint64(0x9FB21C651E98DF25)
_LOW_48 = np.uint64((1 << 48) - 1)
_SCORES = "doc_id long, n_tokens long, n_backoffs long, log_score double"


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, data, offsets in text_blocks(batches):
        tokens = len(word_ranges(data, offsets, PLAIN)[0])
        yield pa.record_batch([pa.array([len(data)]), pa.array([tokens])], ["bytes", "tokens"])


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each value, byte by byte, which compresses where values are sorted or small."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _values(planes: bytes, width: int) -> np.ndarray:
    found = np.frombuffer(planes, np.uint8).reshape(width, -1)
    out = np.zeros((found.shape[1], 8), np.uint8)
    out[:, :width] = found.T
    return out.view("<u8").ravel()


def _steps(values: np.ndarray, width: int) -> bytes:
    """Sorted values as distances from the one before, whose high bytes are mostly zero."""
    return _planes(np.diff(values, prepend=np.uint64(0)), width)


def _sorted_values(steps: bytes, width: int) -> np.ndarray:
    return np.cumsum(_values(steps, width), dtype=np.uint64)


def _words(block: pa.Table) -> Words:
    """Words of a block's texts, found a few megabytes of text at a time."""
    hashes, counts = [], []
    for batch in block.select(["text"]).to_batches():
        for _, data, offsets in text_blocks([batch]):
            w = words(data, offsets)
            hashes.append(w.hashes)
            counts.append(np.diff(w.first))
    lengths = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    none = np.zeros(0, np.int64)
    all_hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return Words(none, none, np.repeat(np.arange(len(lengths)), lengths), all_hashes, np.concatenate(([0], np.cumsum(lengths))))


def _grams(w: Words, order: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For one order after the other, the words that end an n-gram of it, and its hash cut to what a partition tells apart."""
    cut = np.uint64(max(0, 16 - bits))
    place = np.arange(len(w.hashes)) - w.first[w.doc]
    hashes = w.hashes
    for n in range(1, order + 1):
        if n > 1:
            longer = np.zeros_like(hashes)
            longer[1:] = mix(hashes[:-1] * _MIX + w.hashes[1:])
            hashes = longer
        at = np.flatnonzero(place >= n - 1)
        yield at, hashes[at] >> cut << cut


def _counted(order: int, bits: int):
    """A block's distinct n-grams and their counts, by order and table partition."""
    low = np.uint64(max(0, 16 - bits))

    def run(block: pa.Table) -> pa.Table:
        rows = []
        w = _words(block)
        for n, (_, hashes) in enumerate(_grams(w, order, bits), 1):
            found, counts = np.unique(hashes, return_counts=True)
            part = (found >> np.uint64(64 - bits)).astype(np.int64)
            edges = np.concatenate((np.flatnonzero(np.diff(part, prepend=-1)), [len(part)]))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                rows.append((int(part[a]), n, _steps(found[a:b] >> low & _LOW_48, 6), _planes(counts[a:b], 5)))
        number = block.column("block")[0].as_py()
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table(
            {
                "block": pa.array([number] * len(rows), pa.int64()),
                "part": pa.array(columns[0], pa.int64()),
                "n": pa.array(columns[1], pa.int32()),
                "grams": pa.array(columns[2], pa.binary()),
                "counts": pa.array(columns[3], pa.binary()),
            }
        )

    return run


_COUNTED = "block long, part long, n int, grams binary, counts binary"
_TOTALS = "block long, part long, n int, totals binary"


def _added(group: pa.Table) -> pa.Table:
    """Totals of one partition of one order's table, for each block as it asked."""
    grams = [_sorted_values(x.as_py(), 6) for x in group.column("grams")]
    counts = np.concatenate([_values(x.as_py(), 5) for x in group.column("counts")])
    found, place = np.unique(np.concatenate(grams), return_inverse=True)
    totals = np.bincount(place, weights=counts.astype(np.float64), minlength=len(found)).astype(np.uint64)[place]
    edges = np.cumsum([0, *map(len, grams)])
    answers = [_planes(totals[a:b], 6) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return group.select(["block", "part", "n"]).append_column("totals", pa.array(answers, pa.binary()))


def _scored(order: int, bits: int, tokens: int, backoff: float, least: int):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        w = _words(block)
        size = len(w.hashes)
        answers = answers.sort_by([("n", "ascending"), ("part", "ascending")])
        of = answers.column("n").to_numpy()
        # The longest n-gram met often enough decides, so a longer one overwrites what a shorter one gave.
        score, level = np.zeros(size), np.zeros(size, np.int8)
        shorter = np.full(size, tokens, np.float64)
        for n, (at, hashes) in enumerate(_grams(w, order, bits), 1):
            here = np.zeros(size)
            if len(at):
                totals = [_values(answers.column("totals")[int(k)].as_py(), 6) for k in np.flatnonzero(of == n)]
                _, place = np.unique(hashes, return_inverse=True)
                here[at] = np.concatenate(totals)[place]
            good = at[here[at] >= (least if n > 1 else 1)]
            score[good] = np.log(here[good]) - np.log(shorter[good - 1] if n > 1 else tokens)
            level[good] = n
            shorter = here
        steps = np.minimum(np.arange(size) - w.first[w.doc] + 1, order) - level
        score += steps * np.log(backoff)
        lengths = np.diff(w.first)
        sums, backs = np.zeros(len(lengths)), np.zeros(len(lengths), np.int64)
        full = np.flatnonzero(lengths)
        if len(full):
            sums[full] = np.add.reduceat(score, w.first[full])
            backs[full] = np.add.reduceat(steps, w.first[full])
        return pa.table(
            {
                "doc_id": block.column("doc_id"),
                "n_tokens": pa.array(lengths, pa.int64()),
                "n_backoffs": pa.array(backs, pa.int64()),
                "log_score": pa.array(sums, pa.float64()),
            }
        )

    return run


def backoff_scores(
    docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, least: int = LEAST, block_text: int = BLOCK_TEXT
) -> DataFrame:
    """doc_id, n_tokens, n_backoffs, log_score and mean_log_score per row of docs.

    Tokens are runs of what is not white space, A-Z in lower case. A token's score is that of the
    longest n-gram, of ``order`` words at most, that ends with it within its document and was met
    ``least`` times or more in all documents: count of the n-gram / count of its words but the last,
    times ``backoff`` for each order given up on the way. A single word counts however rare, over the
    number of all tokens. ``log_score`` sums natural logarithms over the document, ``mean_log_score`` divides by its tokens.

    Null and empty texts have no tokens, a log_score of 0 and a null mean. Repeated rows count and
    score each; null ids are kept. Whole texts are read; no documents give no rows. Other columns are ignored. N-grams are told
    apart by hashes of 48 bits besides those of the table partition.
    """
    texts = docs.select("doc_id", "text")
    size = texts.mapInArrow(_sizes, "bytes long, tokens long").agg(F.sum("bytes"), F.sum("tokens")).first()
    in_bytes, tokens = (x or 0 for x in size)
    blocks = in_bytes // block_text + 1
    bits = max(4, (tokens // PARTITION_GRAMS).bit_length())
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("long"))
    dealt = dealt.repartition(min(blocks, 100_000), "block")
    counted = dealt.groupBy("block").applyInArrow(_counted(order, bits), _COUNTED)
    totals = counted.groupBy("n", "part").applyInArrow(_added, _TOTALS)
    scores = (
        dealt.groupBy("block")
        .cogroup(totals.groupBy("block"))
        .applyInArrow(_scored(order, bits, tokens, backoff, least), _SCORES)
    )
    return scores.withColumn("mean_log_score", F.try_divide("log_score", "n_tokens"))
