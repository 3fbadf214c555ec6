"""Benchmark decontamination by templates: copies of questions, also with other numbers, names and units.

Words are canonicalised: a word with a digit becomes the placeholder for numbers, a capitalised word
inside a sentence that for names, a unit of measure that for units; the value goes to a slot. Windows
of canonical words are hashed on both sides and joined on the hash, together with windows of the words as
written in lower case, which find copies whatever their letter case and however few plain words they have. Matched windows of a document and
an item are grouped by alignment (difference of positions), and of an alignment only those windows count whose
slots are consistent: an item's value always stands for the same value in the document, that of most windows. A document holds
an item if the windows that count cover enough of it.

Before the join, documents' windows pass a bitmap of the benchmark's hashes whose size is fixed, so
what reaches the shuffle is about what matches, whatever the size of either side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.columns import bind
from stratamart.llm.textblocks import LOWER, RangeHash, Words, text_blocks, windows, word_ranges

WINDOW = 5
# Plain words that a window of a template has at least; any window counts as written.
LITERALS = 3
SIMILARITY = 0.8
# So many words in a row as written, or windows of templates, are a passage of the item, however long the item is.
PASSAGE = 13
FILTER_BITS = 24

# Units of measure, written and short forms.
UNITS = (
    "mm cm m km inch inches ft foot feet yard yards mile miles mg g kg gram grams ton tons lb lbs pound pounds oz "
    "ounce ounces ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes hour hours "
    "day days week weeks month months year years degree degrees percent euro euros dollar dollars cent cents "
    "kmh mph hz khz mhz w kw kwh v volt volts watt watts joule joules byte bytes kb mb gb tb"
).split()

_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[ord("0") : ord("9") + 1] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[ord("A") : ord("Z") + 1] = True
_IS_WORD = _IS_DIGIT | _IS_UPPER
_IS_WORD[ord("a") : ord("z") + 1] = True
_IS_WORD[128:] = True
_ENDS_SENTENCE = np.zeros(256, bool)
_ENDS_SENTENCE[[ord(c) for c in ".!?:;\n"]] = True
_NUMBER, _NAME, _UNIT = (np.uint64(k) for k in (11, 12, 13))

# A window as written has no slots; usable: it has the plain words that a template needs.
_FOUND = "hash long, position int, usable boolean, slots array<long>"


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    starts, ends = word_ranges(data, np.array([0, len(data)]), _IS_WORD)
    return np.sort(RangeHash(data).of(starts, ends))


_UNIT_HASHES = _unit_hashes()


def _before(mask: np.ndarray) -> np.ndarray:
    """How many of the bytes before each place are set."""
    out = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def canonical(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """Canonical words of a block, which of them are slots, and the hashes of the words as written in lower case."""
    is_word, digit = _IS_WORD[data], _IS_DIGIT[data]
    if len(data) > 2:
        # A point or comma between digits belongs to the number.
        inner = (data[1:-1] == ord(".")) | (data[1:-1] == ord(","))
        is_word[1:-1] |= inner & digit[:-2] & digit[2:]
    starts, ends = word_ranges(is_word.view(np.uint8), offsets, np.array([False, True]))
    first = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    written = RangeHash(LOWER[data]).of(starts, ends)
    hashes = written.copy()
    if len(starts):
        digits, stops = _before(digit), _before(_ENDS_SENTENCE[data])
        previous = np.concatenate(([0], ends[:-1]))
        opens = stops[starts] > stops[previous]
        opens[first[:-1][first[:-1] < len(starts)]] = True
        at = np.minimum(np.searchsorted(_UNIT_HASHES, written), len(_UNIT_HASHES) - 1)
        hashes[_UNIT_HASHES[at] == written] = _UNIT
        hashes[_IS_UPPER[data[starts]] & ~opens] = _NAME
        hashes[digits[ends] > digits[starts]] = _NUMBER
    return Words(starts, ends, doc, hashes, first), hashes != written, written


def _found(id_column: str, bitmap: np.ndarray | None, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches):
            w, is_slot, written = canonical(data, offsets)
            at, templates = windows(w, window)
            _, hashes = windows(replace(w, hashes=written), window)
            slots_before = _before(is_slot)
            lengths = slots_before[at + window] - slots_before[at]
            usable = window - lengths >= LITERALS
            # A template without slots is the window as written.
            also = np.flatnonzero(usable & (lengths > 0))
            lengths = np.concatenate((np.zeros_like(lengths), lengths[also]))
            usable = np.concatenate((usable, usable[also]))
            at, hashes = np.concatenate((at, at[also])), np.concatenate((hashes, templates[also]))
            if bitmap is not None:
                place = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                passes = (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                at, hashes, lengths, usable = at[passes], hashes[passes], lengths[passes], usable[passes]
            values = written.view(np.int64)
            # Few windows get here: those of the benchmark, or those the bitmap passes.
            slots = [values[a : a + window][is_slot[a : a + window]] if n else [] for a, n in zip(at, lengths, strict=True)]
            doc = w.doc[at]
            yield pa.record_batch(
                [
                    rows.column(id_column).take(pa.array(doc)),
                    pa.array(hashes.view(np.int64)),
                    pa.array((at - w.first[doc]).astype(np.int32)),
                    pa.array(usable),
                    pa.array(slots, pa.list_(pa.int64())),
                ],
                ["id", "hash", "position", "usable", "slots"],
            )

    return run


def _windows(rows: DataFrame, id_column: str, bitmap: np.ndarray | None, window: int) -> DataFrame:
    schema = f"id {rows.schema[id_column].dataType.simpleString()}, {_FOUND}"
    return rows.where(F.col(id_column).isNotNull()).select(id_column, "text").mapInArrow(_found(id_column, bitmap, window), schema)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for batch in batches:
        place = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)
        np.bitwise_or.at(bits, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
    yield pa.record_batch([pa.array([bits.tobytes()])], ["bits"])


def _consistent(hits: Column) -> Column:
    """The windows of an alignment that agree with the value that most of its windows give each value of the item."""

    def kept(pairs: Column) -> Column:
        def counted(distinct: Column) -> Column:
            return F.transform(
                distinct, lambda p: F.struct(p.alias("pair"), F.size(F.filter(pairs, lambda q: q == p)).alias("n"))
            )

        def usual(found: Column) -> Column:
            def better(a: Column, b: Column) -> Column:
                more = (a["n"] > b["n"]) | ((a["n"] == b["n"]) & (a["pair"]["doc"] < b["pair"]["doc"]))
                return (a["pair"]["item"] == b["pair"]["item"]) & more

            best = F.filter(found, lambda b: ~F.exists(found, lambda a: better(a, b)))
            return F.transform(best, lambda b: b["pair"])

        def agreeing(best: Column) -> Column:
            return F.filter(hits, lambda h: F.forall(h["pairs"], lambda p: F.array_contains(best, p)))

        distinct = F.array_distinct(pairs)
        torn = F.size(distinct) > F.size(F.array_distinct(distinct["item"]))
        return F.when(torn, bind(bind(bind(distinct, counted), usual), agreeing)).otherwise(hits)

    return bind(F.flatten(hits["pairs"]), kept)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    similarity: float = SIMILARITY,
    passage: int = PASSAGE,
) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds: doc_id, item_id, the item's windows, those found, verbatim.

    A pair is returned where one of these holds: at least ``similarity`` of the item's distinct window positions are found,
    as written or, in an alignment, as a template whose slots do not contradict it; as many of the positions that templates
    can use, where those are half of all or more; ``passage`` such positions; ``passage`` words as written in one alignment. ``verbatim`` says
    whether every window found is found as written, letter case aside. A template's windows have three words outside slots
    at least. Items shorter than a window match nothing. Null and empty texts match nothing. Rows with a
    null id are not reported. Rows that share an id are taken as one document or item. Empty tables
    give no rows; other columns are ignored.
    """
    items = _windows(benchmark, "item_id", None, window)
    parts = items.select("hash").coalesce(8).mapInArrow(_bitmaps, "bits binary").collect()
    bitmap = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for part in parts:
        bitmap |= np.frombuffer(part.bits, np.uint8)
    found = _windows(docs, "doc_id", bitmap, window)

    sizes = items.groupBy(F.col("id").alias("item_id")).agg(
        F.countDistinct("position").alias("item_windows"),
        F.countDistinct(F.when(F.col("usable"), F.col("position"))).alias("template_windows"),
    )
    theirs = items.select(
        "hash", F.col("id").alias("item_id"), F.col("position").alias("place"), "usable", F.col("slots").alias("own")
    )
    pairs = F.zip_with("own", "slots", lambda a, b: F.struct(a.alias("item"), b.alias("doc")))
    hit = F.struct("place", "usable", (F.size("own") == 0).alias("written"), pairs.alias("pairs"))
    aligned = (
        found.drop("usable")
        .join(theirs, "hash")
        .groupBy(F.col("id").alias("doc_id"), "item_id", (F.col("position") - F.col("place")).alias("shift"))
        .agg(F.collect_set(hit).alias("hits"))
        .select("doc_id", "item_id", _consistent(F.col("hits")).alias("kept"))
    )
    as_written = F.filter("kept", lambda h: h["written"])["place"]
    in_templates = F.filter("kept", lambda h: h["usable"])["place"]

    def places(of: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.collect_list(of))))

    held = aligned.groupBy("doc_id", "item_id").agg(
        places(F.col("kept.place")).alias("found_windows"),
        places(in_templates).alias("found_templates"),
        places(as_written).alias("found_written"),
        F.max(F.size(as_written)).alias("longest"),
    )
    most_of_item = F.col("found_windows") >= similarity * F.col("item_windows")
    most_of_template = (2 * F.col("template_windows") >= F.col("item_windows")) & (
        F.col("found_templates") >= similarity * F.col("template_windows")
    )
    long_passage = (F.col("found_templates") >= passage) | (F.col("longest") >= passage - window + 1)
    return (
        held.join(sizes, "item_id")
        .where(most_of_item | most_of_template | long_passage)
        .select("doc_id", "item_id", "item_windows", "found_windows", (F.col("found_written") == F.col("found_windows")).alias("verbatim"))
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose texts hold no benchmark item, with all their columns, whatever ids they have or lack."""
    key = "text_digest"
    while key in docs.columns:
        key += "_"
    keyed = docs.withColumn(key, F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    texts = keyed.select(F.col(key).alias("doc_id"), "text")
    held = contaminated(texts, benchmark, **options).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(held, key, "left_anti").select(*docs.columns)
