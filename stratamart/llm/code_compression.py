"""Vectors as short codes: each of 16 parts of a vector by the number of the nearest entry of that part's codebook.

Entries are found through a geometric near-neighbour access tree. A node of the tree has split points, entries that lie far
apart, and gives every other entry to its closest split point; for each pair of a split point and a child it stores between which
distances from the split point the child's entries lie. A query measures its distance to the split points, and a child is left
out, with all that is below it, if the best distance found so far shows for any split point that nothing in
the child's range can be as near. Ranges and radii are rounded outwards and the test is strict, so ties survive to be
decided: squared distances are integers, and of equally near entries the first counts. Many queries go down a tree
together, as arrays.

Codebooks have at most 64 entries per part, whatever the number of vectors: they travel with the tasks. A round adds up, per task, the
components and the number of parts of each entry, and those sums, a row per task, part and component, are added up by Spark.
Sums are of integers, so a task that is run again changes nothing.

Defined results: components become integers by floor(256 x), held within -2**62 and 2**62; arithmetic beyond 63 bits is done
with whole numbers of any length, and an error that does not fit is the largest one that does. Vectors that are null,
or that hold a null or a number that is not finite, go; so do those without components or of another length than the
first, that with the smallest id. A length that 16 does not divide is filled with zeros. Rows without an id are coded but start no
codebook unless ids are too few; rows that share an id start it in the order of their components. Fewer rows than entries make
smaller codebooks, and an empty table gives no rows. Other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.operators.broadcasting import broadcast_if_small
from stratamart.workspace import materialize

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Split points of a node of the tree, and entries that are simply compared.
SPLITS = 6
LEAF = 6

_LARGEST = 1 << 62
# Parts whose components lie within this give squared distances below 2**62 for up to 1024 components.
_NARROW = 1 << 25
_MOST = (1 << 63) - 1


def _squares(queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all queries to all entries, exact."""
    total = np.zeros((len(queries), len(entries)), queries.dtype)
    for k in range(queries.shape[1]):
        step = queries[:, k, None] - entries[None, :, k]
        total += step * step
    return total


def _down(squares: np.ndarray) -> np.ndarray:
    """Distances that are not too large."""
    return np.sqrt(squares.astype(np.float64)) * (1 - 1e-12)


def _up(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * (1 + 1e-12)


@dataclass
class Node:
    """Split points (numbers of entries), and per split point and child the least and the largest distance between them."""

    splits: np.ndarray
    children: list[Node | None]
    least: np.ndarray
    most: np.ndarray


def build(entries: np.ndarray, among: np.ndarray) -> Node | None:
    """The tree over the entries with the given numbers; None over none."""
    if not len(among):
        return None
    if len(among) <= LEAF:
        return Node(among, [], np.zeros((0, 0)), np.zeros((0, 0)))
    # Each next split point is the entry farthest from those chosen.
    chosen = [0]
    far = _squares(entries[among], entries[among[:1]])[:, 0]
    while len(chosen) < SPLITS:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _squares(entries[among], entries[among[chosen[-1:]]])[:, 0])
    splits = among[np.unique(chosen)]
    rest = np.setdiff1d(among, splits)
    squares = _squares(entries[splits], entries[rest])
    owner = squares.argmin(0)
    children, least, most = [], np.full((len(splits), len(splits)), np.inf), np.zeros((len(splits), len(splits)))
    for child in range(len(splits)):
        mine = owner == child
        children.append(build(entries, rest[mine]))
        if mine.any():
            least[:, child] = _down(squares[:, mine].min(1))
            most[:, child] = _up(squares[:, mine].max(1))
    return Node(splits, children, least, most)


def _search(node: Node, queries: np.ndarray, entries: np.ndarray, at: np.ndarray, best: np.ndarray, code: np.ndarray) -> None:
    """Improve the best squared distance and entry of the queries numbered ``at``."""
    squares = _squares(queries[at], entries[node.splits])
    # Split points ascend, and argmin takes the first of equals.
    first = squares.argmin(1)
    nearest, number = squares[np.arange(len(at)), first], node.splits[first]
    better = (nearest < best[at]) | ((nearest == best[at]) & (number < code[at]))
    best[at[better]], code[at[better]] = nearest[better], number[better]
    if not node.children:
        return
    low, high = _down(squares), _up(squares)
    for child, below in enumerate(node.children):
        if below is None:
            continue
        radius = _up(best[at])[:, None]
        out = (low - radius > node.most[:, child]) | (high + radius < node.least[:, child])
        alive = at[~out.any(1)]
        if len(alive):
            _search(below, queries, entries, alive, best, code)


def nearest_entries(parts: np.ndarray, entries: np.ndarray, tree: Node) -> tuple[np.ndarray, np.ndarray]:
    """Per part the number of its nearest entry, the first of equals, and the squared distance."""
    # The first split point starts the search; every query meets it again at the root.
    code = np.full(len(parts), tree.splits[0])
    best = _squares(parts, entries[tree.splits[:1]])[:, 0]
    if len(parts):
        _search(tree, parts, entries, np.arange(len(parts)), best, code)
    return code, best


def _integers(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(256 x) of every component, in rows of ``width`` components; exact also beyond 63 bits of precision."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    with np.errstate(over="ignore"):
        scaled = np.floor(values * SCALE)
    out = np.zeros((len(vectors), width), np.int64)
    out[:, : values.shape[1]] = np.where(scaled >= _LARGEST, _LARGEST, np.where(scaled <= -_LARGEST, -_LARGEST, scaled)).astype(np.int64)
    return out


def _fit_for(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers where squared distances fit, else as integers of any length."""
    if all(not a.size or (int(a.max()) < _NARROW and int(a.min()) > -_NARROW) for a in (parts, entries)):
        return parts, entries
    return parts.astype(object), entries.astype(object)


@dataclass
class Coder:
    """Codebooks, parts x entries x components, and the tree of each."""

    books: np.ndarray

    def __post_init__(self) -> None:
        self._trees = [build(_fit_for(book, book)[1], np.arange(len(book))) for book in self.books]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, vectors x parts, and the sum of squared distances of each vector."""
        split = vectors.reshape(len(vectors), len(self.books), -1)
        codes = np.zeros(split.shape[:2], np.int64)
        errors: list[np.ndarray] = []
        for p, (book, tree) in enumerate(zip(self.books, self._trees, strict=True)):
            codes[:, p], squares = nearest_entries(*_fit_for(split[:, p], book), tree)
            errors.append(squares)
        if all(e.dtype != object and (not e.size or int(e.max()) < 1 << 58) for e in errors):
            return codes, sum(errors)
        return codes, sum(e.astype(object) for e in errors)


def kept_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, label, vector of the rows that can be coded: all components present and finite, all of one length."""
    rows = embeddings.select("vec_id", "label", F.col(vector).alias("vector")).filter(F.col("vector").isNotNull() & (F.size("vector") > 0))
    rows = rows.filter(F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").select(F.size("vector")).first()
    return rows.filter(F.size("vector") == (first[0] if first else 0))


def first_books(rows: DataFrame, width: int) -> np.ndarray:
    """Codebooks of the parts of the first vectors; ``ENTRIES`` rows are read."""
    seeds = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).select("vector").toArrow()
    vectors = _integers(seeds.column(0).combine_chunks(), width)
    return np.ascontiguousarray(vectors.reshape(len(vectors), PARTS, -1).transpose(1, 0, 2))


def _sums(rows: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Per part and entry in use: how many parts it is nearest to, and the sums of their components."""
    width, size = books.shape[0] * books.shape[2], books.shape[2]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, totals, used = Coder(books), {}, np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            vectors = _integers(batch.column(0), width)
            codes, _ = coder.assign(vectors)
            split = vectors.reshape(len(vectors), PARTS, size)
            for p in range(PARTS):
                order = np.argsort(codes[:, p], kind="stable")
                entries, starts = np.unique(codes[order, p], return_index=True)
                narrow = not split.size or max(int(split.max()), -int(split.min())) < 1 << 40
                part = split[order, p] if narrow else split[order, p].astype(object)
                used[p, entries] += np.diff(np.append(starts, len(order)))
                for entry, row in zip(entries, np.add.reduceat(part, starts), strict=True):
                    held = totals.get((p, int(entry)), [0] * size)
                    totals[p, int(entry)] = [a + int(b) for a, b in zip(held, row, strict=True)]
        flat = [(p, e, int(used[p, e]), k, total) for (p, e), row in totals.items() for k, total in enumerate(row)]
        columns = list(zip(*flat, strict=True)) if flat else [()] * 5
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.decimal128(38, 0)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "entry", "n", "k", "total"])

    sums = rows.select("vector").mapInArrow(add, "part int, entry int, n bigint, k int, total decimal(38,0)")
    # At most parts x entries x components rows.
    found = sums.groupBy("part", "entry", "k").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    out: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for row in found:
        out.setdefault((row.part, row.entry), (row.n, [0] * size))[1][row.k] = int(row.total)
    return out


def fit(rows: DataFrame, width: int) -> np.ndarray:
    """Codebooks after ``ROUNDS`` rounds: entries become the mean of what they are nearest to, rounded down."""
    books = first_books(rows, width)
    for _ in range(ROUNDS):
        moved = books.copy()
        for (part, entry), (n, totals) in _sums(rows, books).items():
            moved[part, entry] = [total // n for total in totals]
        books = moved
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits per part) and error of every vector."""
    width = books.shape[0] * books.shape[2]
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"]]).add("code", T.StringType()).add("error", T.LongType())

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        for batch in batches:
            codes, errors = coder.assign(_integers(batch.column("vector"), width))
            letters = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            errors = [min(int(e), _MOST) for e in errors]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(letters, pa.string()), pa.array(errors, pa.int64())],
                schema.names,
            )

    return rows.select("vec_id", "label", "vector").mapInArrow(code, schema)


def compressed(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, code, error, label_error (of all vectors with the label) and codebooks_sha256."""
    rows = kept_vectors(embeddings, vector)
    first = rows.select(F.size("vector")).first()
    if first is None:
        kind = embeddings.schema["vec_id"].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame(
            [], f"vec_id {kind}, code string, error bigint, label_error bigint, codebooks_sha256 string"
        )
    books = fit(rows, PARTS * -(-first[0] // PARTS))
    # Written once: both the sums by label and the rows they are added to are read from it.
    coded = materialize(encode(rows, books), "codes")
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("label").agg(F.least(exact, F.lit(_MOST).cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    sums = sums.select(F.col("label").alias("_label"), "label_error")
    joined = coded.join(broadcast_if_small(materialize(sums, "label-errors")), F.col("label").eqNullSafe(F.col("_label")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
