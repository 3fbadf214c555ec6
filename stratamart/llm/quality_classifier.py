"""Supervised subword embeddings that tell good documents from bad ones.

A document is the mean of learned vectors of its features: words, pairs of adjacent words, and
runs of four bytes, each hashed to one of a fixed number of vectors. A softmax layer over that mean
gives the probability of label 1. Vectors and layer are trained together by stochastic gradient
descent in numpy, in one task, over a sample of labelled documents of a fixed size: which documents
is decided on their ids alone, other tasks turn them into feature counts, and the driver gets the weights.

The mean and the layer are both linear up to the softmax, so scoring needs one number per feature:
its vector times the difference of the two rows of the layer. That table has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.textblocks import LOWER, SAME, mix, text_blocks, words

BITS = 18
DIMENSIONS = 8
# The most labelled documents that a fit uses; beyond that, those with the smallest id hashes.
SAMPLE = 4000
EPOCHS = 6
RATE = 0.5
THRESHOLD = 0.3
SHORT = 4


@dataclass(frozen=True)
class Model:
    """What scoring needs: one number per hashed feature, and the bias."""

    weights: np.ndarray
    bias: float


def held_out(doc_id: Column) -> Column:
    """Whether a document is left out of training; never for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], ...]:
    """For byte runs, words and word pairs: hashed features, which of them lie within one text, and where texts begin."""
    shift = np.uint64(64 - BITS)
    n = len(data)
    runs, within = np.zeros(n, np.uint32), np.zeros(n, bool)
    if n >= SHORT:
        wide = SAME[data].astype(np.uint32)
        for k in range(SHORT):
            runs[: n - SHORT + 1] |= wide[k : n - SHORT + 1 + k] << np.uint32(8 * k)
        within[: n - SHORT + 1] = True
        for k in range(1, SHORT):
            edges = offsets[1:] - k
            within[edges[edges >= 0]] = False
    runs = (runs * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    w = words(data, offsets, fold=LOWER)
    single = w.hashes >> shift
    pairs, together = np.zeros(len(w.doc), np.uint64), np.zeros(len(w.doc), bool)
    if len(w.doc) > 1:
        pairs[:-1] = mix(w.hashes[:-1] * np.uint64(3) + w.hashes[1:]) >> shift
        together[:-1] = w.doc[:-1] == w.doc[1:]
    every = np.ones(len(w.doc), bool)
    return (runs, within, offsets), (single, every, w.first), (pairs, together, w.first)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; ``starts`` has one entry more than there are texts."""
    out = np.zeros(len(starts) - 1, values.dtype)
    full = np.flatnonzero(starts[1:] > starts[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, starts[full])
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_blocks(batches):
        parts = _features(data, offsets)
        ids, counts = [], []
        for k in range(rows.num_rows):
            own = [h[s[k] : s[k + 1]][ok[s[k] : s[k + 1]]].astype(np.uint32) for h, ok, s in parts]
            found, times = np.unique(np.concatenate(own), return_counts=True)
            ids.append(found.tobytes())
            counts.append(np.minimum(times, 65535).astype(np.uint16).tobytes())
        columns = [rows.column("rank"), rows.column("label"), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())]
        yield pa.record_batch(columns, ["rank", "label", "ids", "counts"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, seed: int = 7) -> Model:
    """Train on labelled documents that are not held out.

    Documents need doc_id and text, labels doc_id and ``label``. Labels other than 0 and 1 are
    ignored; of a document with several, the lowest holds. With no usable label the model scores
    every text 0.5. Rows of the sample that share a doc_id all take part.
    """
    usable = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id")
    rank = F.xxhash64("doc_id")
    chosen = usable.agg(F.min(label).cast("int").alias("label")).select("doc_id", "label", rank.alias("rank"))
    chosen = chosen.orderBy("rank", "doc_id").limit(sample)
    # At most ``sample`` rows of fixed width, so the broadcast is bounded.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("rank", "label", "text")
    counted = rows.mapInArrow(_counts, "rank long, label int, ids binary, counts binary")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [
            (rank, ids, counts, label)
            for batch in batches
            for rank, ids, counts, label in zip(*(batch.column(c).to_pylist() for c in ("rank", "ids", "counts", "label")), strict=True)
        ]
        # Rows of equal rank have equal ids or, by the sizes, an order of their own: it does not depend on how they came.
        found.sort(key=lambda r: (r[0], len(r[1]), r[1:]))
        model = _descend([(np.frombuffer(i, np.uint32), np.frombuffer(c, np.uint16), y) for _, i, c, y in found if i], seed)
        yield pa.record_batch([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], ["weights", "bias"])

    # The sample is bounded, so one task holds it; the weights have a fixed size.
    trained = counted.repartition(1).mapInArrow(train, "weights binary, bias double").first()
    return Model(np.frombuffer(bytes(trained.weights), np.float32), trained.bias)


def _descend(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int) -> Model:
    size = 1 << BITS
    if not rows:
        return Model(np.zeros(size, np.float32), 0.0)
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((size, DIMENSIONS), np.float32) - 0.5) / DIMENSIONS).astype(np.float32)
    layer, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            ids, counts, y = rows[k]
            share = counts.astype(np.float32)
            share /= share.sum()
            own = vectors[ids]
            mean = share @ own
            out = layer @ mean + bias
            p = np.exp(out - out.max())
            error = p / p.sum()
            error[y] -= 1
            rate = np.float32(RATE * (1 - done / steps))
            back = layer.T @ error
            layer -= rate * np.outer(error, mean)
            bias -= rate * np.float32(0.1) * error
            # A feature's share is small; scaled by the number of features, each moves as one of a few would.
            own -= np.outer(share * np.float32(len(ids) ** 0.5), rate * back)
            vectors[ids] = own
            done += 1
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def _probabilities(model: Model, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of label 1 of each text of a block."""
    total, number = np.zeros(rows.num_rows), np.zeros(rows.num_rows)
    for hashes, within, starts in _features(data, offsets):
        total += _sums(np.where(within, model.weights[hashes], np.float32(0)).astype(np.float64), starts)
        number += _sums(within.astype(np.int64), starts)
    return 1 / (1 + np.exp(-(total / np.maximum(number, 1) + model.bias)))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1, of label 1) and predicted (score >= threshold) per row of docs.

    Whole texts are read. A null or empty text scores by the bias alone. Repeated rows score
    alike; null ids are kept; other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches):
            out = pa.array(_probabilities(model, rows, data, offsets))
            yield pa.record_batch([rows.column("doc_id"), out], ["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose texts score ``threshold`` or more, with all their columns."""

    # Only the texts go to Python and only scores come back; the rows wait in Spark, so no text is copied back.
    @F.arrow_udf("double")
    def probability(text: pa.Array) -> pa.Array:
        rows = pa.record_batch([text], ["text"])
        parts = [_probabilities(model, block, data, offsets) for block, data, offsets in text_blocks([rows])]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return docs.filter(probability(F.col("text")) >= threshold)
