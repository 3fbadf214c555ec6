"""Quality rules for documents: counts, and divergence from what is usual in their language.

Histograms of a text, its characters by class, its common words, and common beside any other words, are
compared to those of all documents of its language by Jensen-Shannon distance, where the text is long
enough for that to mean something. Everything is built-in functions: one pass over the texts makes a profile per document, which
is stored; the references are sums over profiles, one row per language of a fixed list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.columns import bind, occurrences, plain_words
from stratamart.workspace import materialize

# Frequent function words by language, as many for each.
COMMON = {
    "en": "the of and to in is that it for was on with as at be by".split(),
    "fr": "de la le et les des en un une du que qui dans pour par sur".split(),
    "de": "der die und den von zu das mit sich des auf für ist im dem nicht".split(),
    "es": "de la que el en y a los se del las un por con no una".split(),
}
OTHER = "other"
SYMBOLS = r"[#*$%&|<>]"

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
# Below these a histogram is not compared. So many common words a text has, for which ones they are to be
# compared, or is long enough to be expected to have, for how many there are beside any other words.
LEAST_CHARACTERS = 300
LEAST_COMMON = 20
# Distances are between 0 and 1.
MOST_CHARACTER_DISTANCE = 0.25
MOST_WORD_DISTANCE = 0.6


def repeated_words(words: Column) -> Column:
    """Words within a window of three that is found twice or more, the first included."""

    def covered(grams: Column) -> Column:
        ordered = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            def met_again(x: Column, k: Column) -> Column:
                around = F.array(F.get(s, k - 1)["h"], F.get(s, k + 1)["h"])
                return F.when(F.coalesce(F.array_contains(around, x["h"]), F.lit(False)), x["i"])

            return F.array_sort(F.array_compact(F.transform(s, met_again)))

        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        counted = F.aggregate(
            bind(ordered, places),
            start,
            lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        )
        return F.when(F.size(F.array_distinct(grams)) < F.size(grams), counted["n"]).otherwise(0)

    def from_words(w: Column) -> Column:
        firsts = F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0)))
        grams = F.transform(firsts, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return bind(grams, covered)

    return bind(words, from_words)


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def profiles(docs: DataFrame) -> DataFrame:
    """Counts of each text: words, their characters, symbols, repeats, and the two histograms."""
    text = F.coalesce("text", F.lit(""))
    # Language decides which words are counted; languages not listed have no such histogram.
    listed = F.col("lang").isin(*COMMON)
    rows = docs.select("doc_id", text.alias("text"), F.when(listed, F.col("lang")).otherwise(OTHER).alias("language"))

    def of_words(w: Column) -> Column:
        chosen = F.lit(None).cast("array<int>")
        for language, common in COMMON.items():
            counts = F.array(*(F.size(w) - F.size(F.array_remove(w, x)) for x in common))
            chosen = F.when(F.col("language") == language, counts).otherwise(chosen)
        return F.struct(
            F.size(w).alias("n_words"),
            F.char_length(F.array_join(w, "")).alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
            chosen.alias("common"),
        )

    counted = rows.select(
        "doc_id",
        "language",
        bind(plain_words(F.col("text")), of_words).alias("w"),
        _repeated_lines(F.col("text")).alias("n_dup_lines"),
        F.char_length("text").alias("chars"),
        (F.octet_length("text") - F.char_length("text")).alias("wide"),
        occurrences(F.col("text"), SYMBOLS).alias("n_symbols"),
        occurrences(F.col("text"), "[A-Z]").alias("upper"),
        occurrences(F.col("text"), "[0-9]").alias("digits"),
        occurrences(F.col("text"), r"""[.,;:!?'"()-]""").alias("marks"),
    )
    white = F.col("chars") - F.col("w.word_chars")
    known = [white, F.col("upper"), F.col("digits"), F.col("marks"), F.col("n_symbols"), F.col("wide")]
    rest = F.greatest(F.col("chars") - sum(known[1:], known[0]), F.lit(0))
    classes = F.array(*(c.cast("long") for c in (*known, rest)))
    n_words, repeated = F.col("w.n_words"), F.col("w.n_repeat_words")
    return counted.select(
        "doc_id",
        "language",
        n_words.cast("long").alias("n_words"),
        F.col("w.word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
        ((n_words < LEAST_WORDS) | (100 * repeated.cast("long") > MOST_REPEATED_PERCENT * n_words)).alias("base_failed"),
        "chars",
        classes.alias("classes"),
        F.col("w.common").alias("common"),
    )


def references(profile: DataFrame) -> DataFrame:
    """Summed histograms per language of the documents that pass the counting rules; at most a row per listed language and one more."""
    size = len(next(iter(COMMON.values())))
    kept = profile.where("NOT base_failed")
    return kept.groupBy("language").agg(
        F.array(*(F.sum(F.get("classes", F.lit(k))).cast("double") for k in range(7))).alias("usual_classes"),
        F.array(*(F.sum(F.get("common", F.lit(k))).cast("double") for k in range(size))).alias("usual_common"),
        F.sum("n_words").cast("double").alias("usual_words"),
    )


def distance(one: Column, two: Column) -> Column:
    """Jensen-Shannon distance of two histograms, to base two; null where either is empty or null."""

    def shares(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
        return F.when(total > 0, bind(total, lambda t: F.transform(counts, lambda x: x.cast("double") / t)))

    def term(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    terms = F.zip_with(shares(one), shares(two), lambda p, q: (term(p, q) + term(q, p)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x), F.lit(0.0)))


def _word_distance() -> Column:
    """The larger of two distances: which common words there are, and how many there are beside any other words.

    The second is in parts of the distance of a text that has none, so that 1 is such a text.
    """

    def total(counts: str) -> Column:
        return F.aggregate(counts, F.lit(0.0), lambda acc, x: acc + x.cast("double"))

    def compared(n: Column) -> Column:
        common, usual = n[0], n[1]
        one, two = F.array(common, F.col("n_words") - common), F.array(usual, F.col("usual_words") - usual)
        none = distance(F.array(F.lit(0.0), F.lit(1.0)), two)
        expected = F.col("n_words") * usual >= LEAST_COMMON * F.col("usual_words")
        which = F.when(common >= LEAST_COMMON, distance(F.col("common"), F.col("usual_common")))
        how_many = F.when(expected & (usual > 0), F.least(F.try_divide(distance(one, two), none), F.lit(1.0)))
        return F.greatest(which, how_many)

    return bind(F.array(total("common"), total("usual_common")), compared)


def judged(docs: DataFrame) -> DataFrame:
    """Counts and verdict per row of docs, which has doc_id, text and lang.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated windows of three.
    ``kept``: not so, and neither distance above its limit. A long text with few or no common words has a ``word_distance``
    up to 1, and is rejected. A distance is null, and passes, where the
    text has too few characters or is too short to be expected to have 20 common words, or its language is not listed or
    has no common words in any document. Null and empty
    texts fail. Repeated rows are judged alike and count each in the references; null ids and languages
    are kept; an empty table gives no rows. Other columns are ignored.
    """
    profile = materialize(profiles(docs), "profiles")
    # A row per listed language and one more: bounded by the list.
    both = profile.join(F.broadcast(references(profile)), "language", "left")
    both = both.withColumn(
        "character_distance", F.when(F.col("chars") >= LEAST_CHARACTERS, distance(F.col("classes"), F.col("usual_classes")))
    ).withColumn("word_distance", _word_distance())
    far = (F.coalesce("character_distance", F.lit(0.0)) > MOST_CHARACTER_DISTANCE) | (
        F.coalesce("word_distance", F.lit(0.0)) > MOST_WORD_DISTANCE
    )
    return both.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"),
        "character_distance",
        "word_distance",
    )
