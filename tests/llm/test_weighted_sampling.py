import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratamart.llm import weighted_sampling
from stratamart.llm.weighted_sampling import SAMPLES, compared_with_edits, fingerprints

ODD = [
    (5, "alpha beta beta gamma"), (4, "alpha beta beta gamma"), (3, None), (2, ""), (1, " \t\n "),
    (9, "日本 é ß \U0001f600 x"), (7, "long " * 40000 + "tail"), (None, "no id at all"), (None, "no id at all"), (None, None),
    (6, "a"), (6, "b"), (6, "b"), (8, "one two three four five six"),
]


def words(text):
    return Counter(w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w)


def hash_of(*numbers):
    """Hash of integers as built-in functions chain it: each by the one before; the first may be text."""
    seed = 42
    for n in numbers:
        data = n.encode() if isinstance(n, str) else (n & (1 << 8 * (4 if kind(n) else 8)) - 1).to_bytes(4 if kind(n) else 8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


class Int(int):
    """A number that is hashed as four bytes."""


def kind(n):
    return isinstance(n, Int)


def samples(text):
    """The fingerprint by its definition, place after place."""
    out = []
    for k in range(SAMPLES):
        lowest = None
        for w, n in words(text).items():
            term = hash_of(w)
            h = [hash_of(term, Int(3 * k + d)) for d in range(3)]
            u = [((x >> 32) + 0.5) / 2**32 for x in h], [((x & 0xFFFFFFFF) + 0.5) / 2**32 for x in h]
            r, c, b = -math.log(u[0][0] * u[1][0]), -math.log(u[0][1] * u[1][1]), u[0][2]
            t = math.floor(math.log(n) / r + b)
            place = math.floor((math.log(c) - r * (t - b + 1) + 120) * 2**24)
            found = (place, hash_of(term, t) & 0xFFFFFFFF)
            lowest = found if lowest is None else min(lowest, found)
        out.append(-1 if lowest is None else lowest[1] & 0xFFFF)
    return out


def following(rows):
    """Rows in the order of the operator, each with the text of the next."""
    def order(r):
        h = hash_of(r[1] or "")
        return (r[0] is None, -(r[0] or 0), h - (1 << 64) if h >> 63 else h)

    rows = sorted(rows, key=order)
    return [(d, t or "", rows[(k + 1) % len(rows)][1] or "") for k, (d, t) in enumerate(rows)]


def brute(rows):
    out, known = Counter(), {}

    def fingerprint(text):
        return known.setdefault(text, samples(text))

    def shown(s):
        return "empty" if s[0] < 0 else "".join(f"{x:04x}" for x in s)

    def near(a, b):
        return sum(x == y for x, y in zip(a, b, strict=True)) / SAMPLES

    for doc_id, text, after in following(rows):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, nexts = fingerprint(text), fingerprint(edited), fingerprint(after)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out[doc_id, len(text), digest, shown(own), shown(other), near(own, other), near(own, nexts)] += 1
    return out


def run(spark, rows):
    docs = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "doc_id bigint, text string, slice long, place string")
    return Counter(tuple(r) for r in compared_with_edits(docs.repartition(3)).collect())


@pytest.mark.parametrize("slice_rows", [2, 256])
def test_against_the_definition(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(weighted_sampling, "SLICE_ROWS", slice_rows)
    assert run(spark, ODD) == brute(ODD)


def test_next_texts_across_many_slices(spark, monkeypatch):
    monkeypatch.setattr(weighted_sampling, "SLICE_ROWS", 3)
    rows = [(i * i % 997, f"text number {i}") for i in range(400)]
    found = weighted_sampling.with_next_text(spark.createDataFrame(rows, "doc_id bigint, text string")).filter("not guest")
    assert found.select("slice").distinct().count() > 50
    by_id = Counter((d, after) for d, _, after in following(rows))
    # Rows of one id are in the order of a hash, which following() has too.
    assert Counter((r.doc_id, r.next_text) for r in found.collect()) == by_id


@pytest.mark.parametrize("rows", [[], [(1, "only one row here")], [(None, "only one row here")], [(1, None)]])
def test_small_tables(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_collisions_are_generalised_jaccard(spark):
    rng = np.random.default_rng(3)
    pairs, exact = [], []
    for i in range(600):
        # Words of each pair are its own, so that its draws are independent of those of others.
        a, b = (Counter(f"w{i}.{k}" for k in rng.zipf(1.6, 60) % 40) for _ in range(2))
        union = a | b
        exact.append(sum((a & b).values()) / sum(union.values()))
        pairs += [(i, side, " ".join(c.elements())) for side, c in enumerate((a, b))]
    got = fingerprints(spark.createDataFrame(pairs, "i int, kind int, text string"), ["i"]).select(
        "i", weighted_sampling.likeness(F.slice("samples", 1, SAMPLES), F.slice("samples", SAMPLES + 1, SAMPLES)).alias("near")
    )
    near = {r.i: r.near for r in got.collect()}
    gap = [near[i] - e for i, e in enumerate(exact)]
    assert abs(np.mean(gap)) < 0.02
    assert np.std(gap) < 1.3 * math.sqrt(0.25 / SAMPLES)


def test_plan_shuffles_texts_once_and_has_no_python(spark, capsys):
    compared_with_edits(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
    assert sum(line.strip().startswith("Arguments: hashpartitioning(slice") for line in plan.splitlines()) == 1
