"""Document fingerprints by consistent weighted sampling, in built-in functions.

A text is a set of terms, its words, weighted by how often each occurs. For each of ``SAMPLES`` positions every
term draws r and c from the gamma distribution of shape 2 and b uniformly from [0, 1), all from hashes of the term and the
position. With t = floor(ln(weight) / r + b) the term's place is ln(a) = ln(c) - r (t - b + 1), and the term with the
lowest place is the sample, together with its t. Two texts have the same sample at a position with a probability
that is their generalised Jaccard similarity: the sum of the smaller weights over the sum of the larger ones.

The lowest place is found by an aggregation with one 64-bit minimum per position: the place, to 2**-24, in the upper
bits, and a hash of term and t in the lower ones. A fingerprint keeps 16 bits of that hash per position, so unlike
samples agree by chance once in 65,536 times.

To meet the following document without sorting the table as one, ids are cut at quantiles into slices. A slice is sorted
by itself and ends with a guest, the first document of the slice after it. Texts are shuffled once, by slice;
terms and samples of a row never leave its task.

Defined results: a null text is empty. A text without words has a fingerprint of its own, which is like that of other
such texts alone. Rows without an id come after all others, in the order of a hash of their text; rows that share an id
stand in that order too. A single row follows itself. An empty table gives no rows. Columns besides the id and
the text take no part.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.columns import bind, plain_words

SAMPLES = 32
# Samples drawn by one row of the exploded terms; more make generated methods too long to be compiled.
CHUNK = 2
# Rows that a slice aims at, and the most slices: bounds the list of quantiles, a few bytes each.
SLICE_ROWS = 256
MOST_SLICES = 1 << 16
# Slices of rows without an id, by the upper bits of their hash.
_NULL_BITS = 6

# Places lie between -(ln 2**32 + ln 2**31 + 45) and 4.
_LOWEST = 120
_PLACE_BITS = 24
_SIGN_BITS = 16


def weighted_terms(text: Column) -> Column:
    """Distinct words as hashes, each with the logarithm of the number of its occurrences."""

    def runs(h: Column) -> Column:
        last = F.filter(F.sequence(F.lit(1), F.size(h)), lambda i: ~F.get(h, i).eqNullSafe(F.get(h, i - 1)))
        return bind(
            last,
            lambda ends: F.transform(
                ends,
                lambda end, k: F.struct(
                    F.get(h, end - 1).alias("term"),
                    F.ln((end - F.when(k > 0, F.get(ends, k - 1)).otherwise(0)).cast("double")).alias("ln_weight"),
                ),
            ),
        )

    hashes = F.sort_array(F.transform(plain_words(text), lambda w: F.xxhash64(w)))
    return bind(hashes, lambda h: F.when(F.size(h) > 0, runs(h)))


def _uniform(bits: Column) -> Column:
    """32 bits as a number above 0 and below 1."""
    return (bits + 0.5) * 2.0**-32


def _upper(h: Column) -> Column:
    return F.shiftrightunsigned(h, 32)


def _lower(h: Column) -> Column:
    return h.bitwiseAND(0xFFFFFFFF)


def _lowest_samples(terms: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys and chunk the lowest place of each position; of (keys, term, ln_weight)."""
    keys = [*keys, "chunk"]
    rows = terms.select("*", F.explode(F.array(*(F.lit(j) for j in range(SAMPLES // CHUNK)))).alias("chunk"))
    each = range(CHUNK)

    def drawn(i: int) -> list[Column]:
        position = (F.col("chunk") * CHUNK + i) * 3
        return [F.xxhash64("term", position + d).alias(f"h{d}_{i}") for d in range(3)]

    def gamma(name: str) -> Column:
        return -F.ln(_uniform(_upper(F.col(name))) * _uniform(_lower(F.col(name))))

    rows = rows.select(*keys, "term", "ln_weight", *(c for i in each for c in drawn(i)))
    rows = rows.select(
        *keys, "term", "ln_weight",
        *(c for i in each for c in (
            gamma(f"h0_{i}").alias(f"r{i}"),
            F.ln(gamma(f"h1_{i}")).alias(f"c{i}"),
            _uniform(_upper(F.col(f"h2_{i}"))).alias(f"b{i}"),
        )),
    )
    rows = rows.select(
        *keys, "term",
        *(c for i in each for c in (
            F.col(f"r{i}"), F.col(f"c{i}"), F.col(f"b{i}"),
            F.floor(F.col("ln_weight") / F.col(f"r{i}") + F.col(f"b{i}")).alias(f"t{i}"),
        )),
    )

    def packed(i: int) -> Column:
        place = F.col(f"c{i}") - F.col(f"r{i}") * (F.col(f"t{i}") - F.col(f"b{i}") + 1)
        upper = F.floor((place + _LOWEST) * 2.0**_PLACE_BITS)
        return F.shiftleft(upper, 32).bitwiseOR(_lower(F.xxhash64("term", f"t{i}")))

    return rows.groupBy(*keys).agg(*(F.min(packed(i)).alias(f"m{i}") for i in each))


def fingerprints(texts: DataFrame, keys: list[str], kind: str = "kind", text: str = "text") -> DataFrame:
    """One row per ``keys``: the samples of its texts, ``SAMPLES`` numbers each, in the order of ``kind``.

    All numbers of a text without words are -1. Nothing is shuffled if rows of equal keys are in one partition.
    """
    terms = texts.select(*keys, kind, F.explode_outer(weighted_terms(F.col(text))).alias("_term"))
    terms = terms.select(*keys, kind, "_term.term", "_term.ln_weight")
    lowest = _lowest_samples(terms, [*keys, kind])
    mask = (1 << _SIGN_BITS) - 1
    signs = F.array(*(F.coalesce(F.col(f"m{i}").bitwiseAND(mask), F.lit(-1)).cast("int") for i in range(CHUNK)))
    chunks = lowest.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(kind, "chunk", signs.alias("signs")))).alias("_chunks"))
    return chunks.select(*keys, F.flatten(F.col("_chunks.signs")).alias("samples"))


def as_text(samples: Column) -> Column:
    """Samples in hexadecimal digits; a word for texts without words."""
    digits = F.transform(samples, lambda s: F.lpad(F.lower(F.hex(s)), _SIGN_BITS // 4, "0"))
    return F.when(F.get(samples, 0) < 0, "empty").otherwise(F.array_join(digits, ""))


def likeness(a: Column, b: Column) -> Column:
    """The share of positions at which two fingerprints have the same sample."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda equal: equal)
    return F.size(same) / F.lit(float(SAMPLES))


def _literals(values: Iterable, kind: str) -> Column:
    """An array of constants, by one literal however many there are."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _slices(docs: DataFrame) -> Column:
    """Which slice an id is in: ascending ids, from 1; rows without an id in 0 and below, by descending hash."""
    rows, low = docs.agg(F.count("doc_id"), F.min("doc_id")).first()
    n = max(1, min(MOST_SLICES, math.ceil(rows / SLICE_ROWS)))
    cuts = [] if low is None else [low]
    if n > 1:
        shares = _literals((k / n for k in range(1, n)), "double")
        cuts += docs.agg(F.percentile_approx("doc_id", shares, F.lit(20 * n))).first()[0]
    cuts = sorted(set(cuts))
    bounds = _literals(cuts, "bigint")
    # A search by halves finds how many are not above the id.
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(len(cuts).bit_length()))))
    found = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= F.col("doc_id"), at + step).otherwise(at)
    )
    unknown = -(F.shiftright("_hash", 64 - _NULL_BITS) + (1 << (_NULL_BITS - 1)))
    return F.when(F.col("doc_id").isNull(), unknown.cast("int")).otherwise(found)


def with_next_text(docs: DataFrame) -> DataFrame:
    """Documents in descending order of their ids, by slices: slice, place in it, guest or not, text, following text.

    A guest is the first row of the next slice, after the last slice that of the first, and has no following text.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_hash", F.xxhash64("text"))
    docs = docs.withColumn("slice", _slices(docs))
    # A row per slice: at most MOST_SLICES and those of rows without an id.
    first = docs.groupBy("slice").agg(F.max("doc_id"), F.min("_hash")).collect()
    order = sorted(first, key=lambda r: -r[0])
    edges = [
        {"slice": r[0], "_before": order[k - 1][0], "_id": r[1], "_least": r[2] if r[1] is None else None}
        for k, r in enumerate(order)
    ]
    listed = F.from_json(F.lit(json.dumps(edges)), "array<struct<slice:int,_before:int,_id:bigint,_least:bigint>>")
    edges = spark.range(1).select(F.inline(listed))
    chosen = docs.join(F.broadcast(edges), "slice").filter(
        F.when(F.col("_id").isNull(), F.col("_hash") == F.col("_least")).otherwise(F.col("doc_id") == F.col("_id"))
    )
    guests = chosen.groupBy("_before").agg(F.min_by("text", "_hash").alias("text"))
    all_rows = docs.withColumn("guest", F.lit(False)).unionByName(
        guests.select(
            F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
            "text", F.lit(0).cast("bigint").alias("_hash"), F.col("_before").alias("slice"), F.lit(True).alias("guest"),
        )
    )
    w = Window.partitionBy("slice").orderBy("guest", F.desc_nulls_last("doc_id"), "_hash")
    return all_rows.select(
        "slice", F.row_number().over(w).alias("place"), "guest", "doc_id", "text", F.lead("text").over(w).alias("next_text")
    )


def compared_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text whose second half is the beginning of the next document's.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint; near_edited and near_next are how like the text's
    fingerprint is to that of its edited text and to the next document's.
    """
    n = F.char_length("text")
    half = (n / 2).cast("int")
    rows = with_next_text(docs).withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)))
    # As bytes and numbers, these go along as keys of the aggregations: no join has to bring them back.
    rows = rows.select(
        "slice", "place", "guest", "doc_id", n.cast("bigint").alias("n_chars"),
        F.unhex(F.sha2("edited", 256)).alias("sha"), "text", "edited",
    )
    keys = ["slice", "place", "guest", "doc_id", "n_chars", "sha"]
    both = F.array(F.struct(F.lit(0).alias("kind"), "text"), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))
    texts = rows.select(*keys, F.inline(F.when(F.col("guest"), F.slice(both, 1, 1)).otherwise(both)))
    own, edited = F.slice("samples", 1, SAMPLES), F.slice("samples", SAMPLES + 1, SAMPLES)
    w = Window.partitionBy("slice").orderBy("place")
    found = fingerprints(texts, keys).select(*keys, own.alias("own"), edited.alias("edited"))
    found = found.withColumn("following", F.lead("own").over(w)).filter(~F.col("guest"))
    return found.select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
