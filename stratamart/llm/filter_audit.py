"""How filters of documents overlap: what each would remove in every order of all of them.

Five conditions make a document fail: A too few words, B too few distinct words for its words, C too many capitals, D
a symbol, E a text that a smaller id has too. A and B are decided on row sums and nonzero entries of the document-term
matrix. The conditions a document fails are a number of five bits, and all that is asked of an order of the filters follows
from how many documents of a part have each number: at most 32 rows per part, whatever the number of documents.

Defined results: a null text is empty, a null source is the empty part. Rows without an id never fail E and have no label;
of equal rows none is a copy of the other. Labels of one id given several times count if any of them says so.
An empty table gives no rows. Other columns of the tables take no part.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.term_matrix import row_totals, term_matrix
from stratamart.workspace import materialize

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
SYMBOLS = "#$%&*|"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True

_ORDERS = ["".join(p) for p in permutations(FILTERS)]


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def _flag(condition: Column, letter: str) -> Column:
    return F.when(condition, _bit(letter)).otherwise(0)


def letters(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Code points, capitals and symbols of each text."""

    def count(which: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(which), offsets))

    # Bytes that go on with a code point are 10xxxxxx.
    chars = np.diff(offsets) - count((data & 0xC0) == 0x80)
    capitals = (data >= ord("A")) & (data <= ord("Z"))
    return {"n_chars": chars, "n_capitals": count(capitals), "n_symbols": count(_IS_SYMBOL[data])}


def failed_filters(docs: DataFrame, source: str = "source") -> DataFrame:
    """doc_id, part, n_words, n_distinct, and ``failed``: a bit for each filter that the document fails, A the lowest."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", F.coalesce(source, F.lit("")).alias("part"), text.alias("text"))
    texts = texts.withColumn("digest", F.unhex(F.sha2("text", 256)))
    _, matrix = term_matrix(texts, ["doc_id", "part", "digest"], "text", letters, ("n_chars", "n_capitals", "n_symbols"))
    by_text = (
        _flag(F.col("n_words") < LEAST_WORDS, "A")
        + _flag(100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"), "B")
        + _flag(100 * F.col("n_capitals") > MOST_CAPITALS * F.col("n_chars"), "C")
        + _flag(F.col("n_symbols") > 0, "D")
    )
    totals = row_totals(matrix).select("doc_id", "part", "digest", "n_words", "n_distinct", by_text.alias("failed"))
    rows = materialize(totals, "totals")
    # Text and id together: copies of one text are no more than single rows of this join.
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    return rows.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", "n_words", "n_distinct", (F.col("failed") + _flag(copy, "E")).alias("failed")
    )


def interactions(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step in it, what the filter of that step removes, and beside which others."""
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic")
    )
    counts = (
        failed.select("doc_id", "part", "failed")
        .join(marks, "doc_id", "left")
        .groupBy("part", "failed")
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("_good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("_toxic"), F.lit(0)).alias("toxic"),
        )
    )
    step = F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")
    steps = counts.select("*", F.explode(F.lit(_ORDERS)).alias("filter_order")).select("*", step)
    here, before = F.lit(0), F.lit(0)
    for letter in FILTERS:
        place = F.instr("filter_order", letter)
        here = here + F.when(place == F.col("step"), _bit(letter)).otherwise(0)
        before = before + F.when(place < F.col("step"), _bit(letter)).otherwise(0)
    steps = steps.withColumns({"_here": here, "_before": before})
    fails = F.col("failed").bitwiseAND(F.col("_here")) != 0
    gone = F.col("failed").bitwiseAND(F.col("_before")) != 0

    def total(of: str | Column, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(of) if isinstance(of, str) else of).otherwise(0)).cast("bigint")

    # A document that fails k filters is removed by each of them in 1/k of all orders.
    in_all_orders = F.col("n") * (len(_ORDERS) / F.greatest(F.bit_count("failed"), F.lit(1))).cast("bigint")
    return steps.groupBy("part", "filter_order", "step").agg(
        total("n", ~gone & ~fails).alias("kept"),
        total("n", fails & ~gone).alias("removed"),
        total("n", fails & gone).alias("redundant"),
        total("n", F.col("failed") == F.col("_here")).alias("unique_fails"),
        total("good", fails & ~gone).alias("good_lost"),
        total("toxic", fails & ~gone).alias("toxic_lost"),
        total(in_all_orders, fails).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return interactions(failed_filters(docs), labels)
