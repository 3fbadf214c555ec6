import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from stratamart.llm import code_compression
from stratamart.llm.code_compression import build, compressed, nearest_entries

NAN, INF = float("nan"), float("inf")


def brute(rows):
    """Plain whole numbers, every entry compared."""
    kept = [(i, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // 16)
    whole = [[max(-(2**62), min(2**62, math.floor(256 * x))) for x in v] + [0] * (16 * width - len(v)) for _, v, _ in kept]
    parts = [[v[p * width : (p + 1) * width] for p in range(16)] for v in whole]
    books = [[parts[k][p] for k in range(min(64, len(parts)))] for p in range(16)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(2):
        moved = [[list(e) for e in b] for b in books]
        for p in range(16):
            groups = {}
            for v in parts:
                groups.setdefault(nearest(p, v[p])[1], []).append(v[p])
            for e, members in groups.items():
                moved[p][e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
        books = moved
    found = [[nearest(p, v[p]) for p in range(16)] for v in parts]
    errors = [sum(d for d, _ in f) for f in found]
    sums = Counter()
    for (_, _, label), e in zip(kept, errors, strict=True):
        sums[label] += e
    most = 2**63 - 1
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return Counter(
        (r[0], "".join(f"{k:02x}" for _, k in f), min(e, most), min(sums[r[2]], most), digest)
        for r, f, e in zip(kept, found, errors, strict=True)
    )


def rows_of(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, code string").repartition(3)
    return Counter(tuple(r) for r in compressed(df).collect())


def as_floats(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


def vectors(n, width, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (12, width))
    return [as_floats(centres[rng.integers(12)] + rng.normal(0, 0.1, width)) for _ in range(n)]


ODD = [
    (900, None, 1), (901, [None] * 64, 1), (902, [NAN] + [0.0] * 63, 1), (903, [INF] + [0.0] * 63, None),
    (904, [], 2), (905, [1.0] * 63, 2), (None, [0.25] * 64, None), (None, [0.25] * 64, None), (2, [0.5] * 64, 3), (2, [0.5] * 64, 3),
]


@pytest.mark.parametrize("width", [64, 16, 40])
def test_against_comparing_every_entry(spark, width):
    rows = [(i, v, i % 4 or None) for i, v in enumerate(vectors(300, width, width))]
    rows = rows[::-1] + (ODD if width == 64 else [])
    assert rows_of(spark, rows) == brute(rows)


def test_few_rows_equal_rows_and_huge_components(spark):
    few = [(i, v, 1) for i, v in enumerate(vectors(5, 32, 1))]
    assert rows_of(spark, few) == brute(few)
    same = [(i, [0.125] * 32, 1) for i in range(100)]
    assert rows_of(spark, same) == brute(same)
    huge = [(i, as_floats([3e38, -3e38, 1e7 * i, -1e6 * i] * 8), i % 2) for i in range(90)]
    assert rows_of(spark, huge) == brute(huge)


def test_nothing_kept(spark):
    assert rows_of(spark, [(1, None, 1), (2, [NAN], 2)]) == Counter()


def test_tree_leaves_subtrees_out_and_keeps_ties(monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.integers(-4000, 4000, (9, 4))
    entries = centres[rng.integers(9, size=64)] + rng.integers(-30, 30, (64, 4))
    # On a small grid many entries are equally near, and some are equal.
    grid = rng.integers(-2, 3, (64, 4))
    for book in (entries, grid):
        queries = np.concatenate([book, book + rng.integers(-20, 20, (64, 4)), rng.integers(-3, 4, (500, 4))])
        compared = []
        plain = code_compression._squares
        monkeypatch.setattr(code_compression, "_squares", lambda q, e, f=plain, c=compared: (c.append(len(q) * len(e)), f(q, e))[1])
        tree = build(book, np.arange(64))
        compared.clear()
        code, best = nearest_entries(queries, book, tree)
        monkeypatch.setattr(code_compression, "_squares", plain)
        squares = plain(queries, book)
        assert (code == squares.argmin(1)).all() and (best == squares.min(1)).all()
        if book is entries:
            assert sum(compared) < 0.6 * queries.shape[0] * 64
