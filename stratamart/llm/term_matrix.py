"""The sparse document-term matrix of a table of texts.

Tasks cut their texts into shards of some megabytes and write each as compressed sparse rows over a dictionary of the
shard's own words: which words the rows have, and how often. The words of all shards, each once per shard, then meet by
word, in the one shuffle that carries words: the number of a word in the whole table is the smallest of its numbers in shards.
Only numbers that differ go back to their shards, whose columns are renamed by them. So a word crosses the network
once per shard that has it, however often it occurs, and no task ever holds a dictionary larger than a shard.
A shard is stored and shuffled in blocks of few texts, each with its share of the words, so that no row of a table is
longer than a block or a single text needs; all of a shard meets in Arrow batches alone, one shard at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.llm.textblocks import PLAIN, text_blocks, word_ranges
from stratamart.workspace import new_folder

SHARD_BYTES = 16 << 20
# Bytes of text whose rows of the matrix are one row of a table.
BLOCK_BYTES = 512 << 10
# Blocks are few and large: a writer would hold a hundred of them before it first looks at their size. Words and places
# differ too much for Parquet's own dictionaries.
_WRITTEN = {
    "compression": "zstd",
    "parquet.block.size": str(8 << 20),
    "parquet.page.size.row.check.min": "1",
    "parquet.enable.dictionary#terms.list.element": "false",
    "parquet.enable.dictionary#places.list.element": "false",
}
# A word's number in its shard: the task that cut the shard, the shard's place there, the word's place in it.
_SHARD_BITS = 12
_WORD_BITS = 28

# Numbers of each text of a block, from the bytes of all texts and the offsets between them.
Measure = Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of a block in order, and how many each text has."""
    starts, ends = word_ranges(data, offsets, PLAIN)
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    letters = np.ascontiguousarray(data[PLAIN[data]])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(letters))
    return words, np.diff(np.searchsorted(starts, offsets))


# Where each row of a block begins and the last one ends, places and counts of its words.
Block = tuple[np.ndarray, np.ndarray, np.ndarray]


def _cuts(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of texts that have ``most`` bytes, or a single one more: the first text and that after the last."""
    cuts, first, n = [], 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        cuts.append((first, min(max(last, first + 1), n)))
        first = cuts[-1][1]
    return cuts


def _rows_of_words(data: np.ndarray, offsets: np.ndarray, cuts: list[tuple[int, int]]) -> tuple[pa.Array, Iterator[Block]]:
    """The distinct words of a shard, and by runs of texts, per text, the places of its words among them, ascending, with their counts."""
    # A run at a time, so that of the whole shard only the distinct words of runs and their indices are held.
    own, found = [], []
    for a, b in cuts:
        words, in_text = _words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        coded = words.dictionary_encode()
        own.append(coded.dictionary)
        found.append((in_text, coded.indices.to_numpy(zero_copy_only=False)))
    merged = pa.chunked_array(own, pa.large_string()).dictionary_encode()
    terms = merged.chunk(0).dictionary if merged.num_chunks else pa.array([], pa.large_string())
    most = max(1, len(terms))

    def rows() -> Iterator[Block]:
        for (in_text, at), chunk in zip(found, merged.chunks, strict=True):
            places = chunk.indices.to_numpy(zero_copy_only=False)[at]
            pairs, counts = np.unique(np.repeat(np.arange(len(in_text)), in_text) * most + places, return_counts=True)
            indptr = np.zeros(len(in_text) + 1, np.int64)
            np.cumsum(np.bincount(pairs // most, minlength=len(in_text)), out=indptr[1:])
            yield indptr, (pairs % most).astype(np.int32), counts.astype(np.int32)

    return terms, rows()


def _lists(values: np.ndarray, kind: pa.DataType = pa.int32()) -> pa.Array:
    """One list that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _shard_number(task: int, place: int) -> int:
    if place >> _SHARD_BITS:
        raise OverflowError("a task may cut no more than 4,096 shards: read the texts in smaller splits")
    return task << _SHARD_BITS | place


def local_shards(
    texts: DataFrame, keep: list[str], text: str = "text", measure: Measure | None = None, measured: tuple[str, ...] = ()
) -> DataFrame:
    """Blocks of shards over their own words: shard, rows (the kept columns of each text), start, terms, indptr, places, counts.

    A block has the ``terms`` of its shard from the place ``start`` on, as many as make the shares of all its blocks alike; its
    ``places`` are those of the whole shard. ``measure`` adds the numbers named in ``measured`` to the rows.
    """
    kept = T.StructType([texts.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in measured])
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("rows", T.ArrayType(kept))])
    schema = schema.add("start", T.LongType()).add("terms", T.ArrayType(T.StringType()))
    schema = schema.add("indptr", ints).add("places", ints).add("counts", ints)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, (block, data, offsets) in enumerate(text_blocks(batches, text, SHARD_BYTES)):
            cuts = _cuts(offsets, BLOCK_BYTES)
            terms, blocks = _rows_of_words(data, offsets, cuts)
            if len(terms) >> _WORD_BITS:
                raise OverflowError("a text has too many different words")
            for (a, b), (indptr, places, counts) in zip(cuts, blocks, strict=True):
                numbers = measure(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) if measure else {}
                rows = pa.StructArray.from_arrays(
                    [block.column(c)[a:b] for c in keep] + [pa.array(numbers[c], pa.int64()) for c in measured], [*keep, *measured]
                )
                # Shares of words go by shares of texts.
                start, end = (len(terms) * i // block.num_rows for i in (a, b))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_shard_number(task, k)], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), rows),
                        pa.array([start], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, end - start], pa.int32()), terms[start:end].cast(pa.string())),
                        _lists(indptr),
                        _lists(places),
                        _lists(counts),
                    ],
                    schema.names,
                )

    return texts.select(*keep, text).mapInArrow(cut, schema)


def term_matrix(
    texts: DataFrame, keep: list[str], text: str = "text", measure: Measure | None = None, measured: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """The dictionary (term, term_id) of all texts, and their matrix in shards of compressed sparse rows.

    A row of the matrix is a block of a shard, with ``rows``, the kept columns and measured numbers of each of its texts;
    ``indptr``, where each text's row begins and the last one ends; and for each of its words in turn ``columns``, the word's id,
    and ``counts``. Ids are not consecutive. A null or empty text is a row without words; an empty table has no shards.
    """
    spark = texts.sparkSession
    # Written once: shards are numbered by the task that cuts them, and both the words and the rows are read.
    path = new_folder(spark, "shards")
    cut = local_shards(texts, keep, text, measure, measured)
    cut.write.options(**_WRITTEN).parquet(path)
    local = spark.read.schema(cut.schema).parquet(path)
    own = (F.shiftleft("shard", _WORD_BITS).bitwiseOR(F.col("start") + F.col("place"))).alias("own")
    words = local.select("shard", "start", F.posexplode("terms").alias("place", "term")).select("term", own)
    # A word has as many rows here as shards have it.
    known = words.withColumn("term_id", F.min("own").over(Window.partitionBy("term")))
    dictionary = known.filter("own = term_id").select("term", "term_id")
    place = F.col("own").bitwiseAND((1 << _WORD_BITS) - 1).cast("int").alias("place")
    renamed = known.filter("own != term_id").select(F.shiftright("own", _WORD_BITS).alias("shard"), place, "term_id")
    blocks = local.drop("start", "terms")
    schema = T.StructType([f for f in blocks.schema.fields if f.name != "places"])
    schema = schema.add("columns", T.ArrayType(T.LongType()))

    def rename(shard: pa.Table, names: pa.Table) -> pa.Table:
        rows = [batch.slice(k, 1) for batch in shard.to_batches() for k in range(batch.num_rows)]
        places = [row.column("places").flatten().to_numpy(zero_copy_only=False) for row in rows]
        ids = np.arange(max((int(p.max()) + 1 for p in places if len(p)), default=0))
        ids += rows[0].column("shard")[0].as_py() << _WORD_BITS
        ids[names.column("place").to_numpy()] = names.column("term_id").to_numpy()
        # A batch each: what goes back is no larger than a block at a time.
        return pa.Table.from_batches(
            pa.RecordBatch.from_arrays(
                [row.column(c) for c in schema.names[:-1]] + [_lists(ids[p], pa.int64())], schema.names
            )
            for row, p in zip(rows, places, strict=True)
        )

    # The new names of a shard stream in beside its blocks: a shard may have as many as words.
    return dictionary, blocks.groupBy("shard").cogroup(renamed.groupBy("shard")).applyInArrow(rename, schema)


def row_totals(matrix: DataFrame) -> DataFrame:
    """Per text the kept columns, the sum of its row of the matrix (``n_words``) and its nonzero entries (``n_distinct``)."""

    def total(k: Column) -> Column:
        begin, end = F.get("indptr", k), F.get("indptr", k + 1)
        counts = F.slice("counts", begin + 1, end - begin)
        return F.struct(
            F.get("rows", k).alias("row"),
            F.aggregate(counts, F.lit(0).cast("bigint"), lambda n, c: n + c).alias("n_words"),
            (end - begin).cast("bigint").alias("n_distinct"),
        )

    rows = F.transform(F.sequence(F.lit(0), F.size("rows") - 1), total)
    return matrix.select(F.inline(rows)).select("row.*", "n_words", "n_distinct")
