"""Secrets in texts: known forms by pattern, unknown ones by entropy.

Patterns give matches and, from the pieces between them, their places. Besides, long runs of the
characters keys are made of are candidates. A window slides over each: Shannon entropy is kept up to
date from the counts of the character that enters and the one that leaves. Known forms and allowed words are cut out of a candidate;
each piece left that is long enough is a secret where the highest entropy of a window reaches the limit of its character class and no allowed form
covers it. Built-in functions only, and no shuffle: a row's result comes from that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.columns import bind

# The forms that are always secrets, in the order in which ties are listed.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
# Runs of one character class: a shorter run fails, and no match begins inside a longer one.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
WINDOW = 20
# Character classes of candidates, the first that fits, and the entropy in bits that a window needs.
CLASSES = (
    (r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0),
    (r"^(?:[0-9a-z]+|[0-9A-Z]+)$", 3.6),
    (r"^[0-9A-Za-z]+$", 3.9),
    (r"^[0-9A-Za-z+/=_-]+$", 4.0),
)
# With fewer digits more entropy is needed; letters of both cases have to alternate besides, as in keys but not in names
# of several words: at least so often as every third place.
LEAST_DIGITS = 2
FEW_DIGITS_MIXED = 4.0
FEW_DIGITS_ONE_CASE = 4.1
MOST_PLACES_PER_CHANGE = 3
# What looks random and is not secret, as a whole, and words in it by length.
ALLOWED = (
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"^[0-9+/=_-]+$",
)
ALLOWED_WORDS = {
    11: "placeholder",
    10: "0123456789|abcdefghij|qwertyuiop",
    8: "changeme|redacted",
    7: "example",
    6: "sample",
    5: "dummy|your[_-]",
    4: "xxxx",
}
# What joins words and stands at the edge of a piece is not part of it.
EDGE = r"(?<=\x20)[+/=_-]|[+/=_-](?=\x20)"

CHUNK = 512
PART = 128
REDACTED = "[SECRET]"


def _sums_before(values: Column) -> Column:
    """For each value the sum of those before it; in chunks, so that long arrays are not copied for every element."""

    def grow(start: Column, part: Column) -> Column:
        first = F.struct(start.alias("sum"), F.array().cast("array<int>").alias("out"))
        step = lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.array_append(acc["out"], acc["sum"]).alias("out"))
        return F.aggregate(part, first, step)["out"]

    def of(x: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / CHUNK).cast("int"))
        chunks = F.transform(numbers, lambda k: F.slice(x, k * CHUNK + 1, CHUNK))
        totals = F.transform(chunks, lambda part: F.aggregate(part, F.lit(0), lambda acc, v: acc + v))
        return bind(
            chunks,
            lambda c: F.flatten(F.zip_with(c, grow(F.lit(0), totals), lambda part, start: grow(start, part))),
        )

    return F.when(F.size(values) > 0, bind(values, of)).otherwise(F.array().cast("array<int>"))


def _spans(text: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """(start, kind, end) of every match, in code points; ``keep``: for each match whether it counts."""
    matches = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.char_length)
    gaps = F.transform(F.split(text, pattern), F.char_length)
    pairs = F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.struct(m.alias("m"), g.alias("g")))

    def placed(p: Column) -> Column:
        before = _sums_before(F.transform(p, lambda x: x["m"] + x["g"]))
        return F.zip_with(
            p,
            before,
            lambda x, b: F.struct(
                (b + x["g"]).alias("start"), F.lit(kind).alias("kind"), (b + x["g"] + x["m"]).alias("end")
            ),
        )

    found = bind(pairs, placed)
    if keep is not None:
        found = bind(keep, lambda k: F.filter(found, lambda _, i: F.get(k, i)))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def _highest_entropy(s: Column) -> Column:
    """Highest entropy in bits of a window sliding over a string of at least a window's length.

    Long strings are cut into parts that overlap by a window less one, as a character's place is found by counting.
    """

    def weight(count: Column) -> Column:
        return F.when(count > 0, count * F.log2(count)).otherwise(0.0)

    def times(x: Column, within: Column) -> Column:
        return (F.char_length(within) - F.char_length(F.replace(within, x, F.lit("")))).cast("double")

    def of_part(part: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            enters, leaves = F.substring(part, i, F.lit(1)), F.substring(part, i - WINDOW, F.lit(1))
            full = i > WINDOW
            before = F.when(full, F.substring(part, i - WINDOW, F.lit(WINDOW))).otherwise(
                F.substring(part, F.lit(1), i - 1)
            )

            def sums(c: Column) -> Column:
                # c: how often the one that enters, and the one that leaves, were in the window before.
                came = acc["sum"] + weight(c[0] + 1) - weight(c[0])
                gone = c[1] + (leaves == enters).cast("double")
                return F.when(full, came + bind(gone, lambda g: weight(g - 1) - weight(g))).otherwise(came)

            counts = bind(before, lambda w: F.array(times(enters, w), times(leaves, w)))
            now = bind(counts, sums)
            return bind(
                now,
                lambda n: F.struct(
                    n.alias("sum"),
                    F.when(i >= WINDOW, F.greatest(acc["best"], F.log2(F.lit(float(WINDOW))) - n / WINDOW))
                    .otherwise(0.0)
                    .alias("best"),
                ),
            )

        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
        return F.aggregate(F.sequence(F.lit(1), F.char_length(part)), start, step)["best"]

    starts = F.sequence(F.lit(1), F.greatest(F.char_length(s) - WINDOW + 1, F.lit(1)), F.lit(PART))
    parts = F.transform(starts, lambda k: F.substring(s, k, F.lit(PART + WINDOW - 1)))
    return F.array_max(F.transform(parts, of_part))


def _is_secret(s: Column) -> Column:
    limit = F.lit(None).cast("double")
    for form, bits in reversed(CLASSES):
        limit = F.when(s.rlike(form), bits).otherwise(limit)
    digits = F.char_length(F.regexp_replace(s, "[^0-9]", "")) >= LEAST_DIGITS
    changes = F.char_length(F.regexp_replace(s, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])", " ")) - F.char_length(s)
    mixed = s.rlike("[a-z]") & s.rlike("[A-Z]")
    alternating = F.when(MOST_PLACES_PER_CHANGE * changes >= F.char_length(s), FEW_DIGITS_MIXED)
    needed = F.when(digits, limit).when(mixed, alternating).otherwise(FEW_DIGITS_ONE_CASE)
    allowed = F.lit(False)
    for form in ALLOWED:
        allowed = allowed | s.rlike(form)
    return F.when(~allowed & needed.isNotNull(), _highest_entropy(s) >= needed).otherwise(F.lit(False))


def _blanked(s: Column, start: Column, base: Column) -> Column:
    """A candidate with spaces in place of the base spans and allowed words in it, and of what joined the rest to them."""

    def cut(acc: Column, b: Column) -> Column:
        first = F.greatest(b["start"] - start, F.lit(0))
        n = F.least(b["end"] - start, F.char_length(s)) - first
        return F.overlay(acc, F.repeat(F.lit(" "), n), first + 1, n)

    touching = F.filter(base, lambda b: (b["start"] < start + F.char_length(s)) & (start < b["end"]))
    out = F.aggregate(touching, s, cut)
    for length, words in ALLOWED_WORDS.items():
        out = F.regexp_replace(out, f"(?i){words}", " " * length)
    return F.regexp_replace(out, EDGE, " ")


def _pieces(text: Column) -> Column:
    """(start, kind, end, piece) of every candidate in a text."""
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    return F.zip_with(_spans(text, CANDIDATE, 3), found, lambda x, piece: x.withField("piece", piece))


def _located(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """docs with columns beside its own, and those of them that hold the base spans and all spans: (start, kind, end) in order of start and kind."""
    name = "secrets"
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    base, left, all_spans = (f"{name}_{x}" for x in ("base", "left", "all"))
    text = F.coalesce("text", F.lit(""))
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = _spans(text, ASSIGN, 0, F.transform(values, lambda v: F.char_length(v) >= ASSIGN_LEAST))

    def cut(b: Column) -> Column:
        return F.transform(_pieces(text), lambda c: F.struct(c["start"].alias("at"), _blanked(c["piece"], c["start"], b).alias("left")))

    def judged(c: Column) -> Column:
        def span(x: Column) -> Column:
            return F.struct((x["start"] + c["at"]).alias("start"), x["kind"].alias("kind"), (x["end"] + c["at"]).alias("end"))

        return F.transform(F.filter(_pieces(c["left"]), lambda x: _is_secret(x["piece"])), span)

    # A column each, as an expression of all steps would be nested too deep to be resolved.
    found = (
        docs.withColumn(base, F.array_sort(F.concat(assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2))))
        .withColumn(left, bind(F.col(base), cut))
        .withColumn(all_spans, F.array_sort(F.concat(base, F.flatten(F.transform(left, judged)))))
    )
    return found, F.col(base), F.col(all_spans)


def _shown(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")


def secrets(docs: DataFrame) -> DataFrame:
    """Per row of docs its secrets: n_assign, n_access, n_hex, base_sha256, spans.

    ``spans`` lists kind:start:end, code points, end exclusive, by start and then kind. Kinds are found
    each for itself, so base spans may overlap; entropy spans lie outside base spans and are pieces of 20 characters or
    more between them and allowed words. Null and empty texts have none. Whole texts are scanned. Repeated rows give equal rows; null ids
    are kept; other columns are ignored; an empty table gives no rows.
    """
    found, base, all_spans = _located(docs.select("doc_id", "text"))
    kinds = base["kind"]
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_shown(base).cast("binary"), 256).alias("base_sha256"),
        _shown(all_spans).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = REDACTED) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``, spans that overlap or touch by one; other columns as they are."""
    found, _, spans = _located(docs)

    def step(acc: Column, s: Column) -> Column:
        # Keeps what stands before each run of spans, and where the run ends.
        inside = s["start"] <= acc["end"]
        piece = F.substring(F.col("text"), acc["end"] + 1, s["start"] - acc["end"])
        pieces = F.when(inside, acc["pieces"]).otherwise(F.array_append(acc["pieces"], piece))
        return F.struct(F.greatest(acc["end"], s["end"]).alias("end"), pieces.alias("pieces"))

    first = spans[0]
    start = F.struct(
        first["end"].alias("end"), F.array(F.substring(F.col("text"), F.lit(1), first["start"])).alias("pieces")
    )
    rest = F.slice(spans, 2, F.greatest(F.size(spans) - 1, F.lit(0)))

    def joined(run: Column) -> Column:
        tail = F.substring(F.col("text"), run["end"] + 1, F.char_length("text"))
        return F.array_join(F.array_append(run["pieces"], tail), mark)

    clean = F.when(F.size(spans) > 0, bind(F.aggregate(rest, start, step), joined)).otherwise(F.col("text"))
    return found.withColumn("text", clean).select(*docs.columns)
