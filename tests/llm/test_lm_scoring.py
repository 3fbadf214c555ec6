import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from stratamart.llm import lm_scoring
from stratamart.llm.lm_scoring import _planes, _sorted_values, _steps, _values, backoff_scores

SCHEMA = "doc_id long, text string, block string"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, order, backoff=0.4, least=2):
    counts = Counter()
    total = 0
    for _, text in rows:
        words = tokens(text)
        total += len(words)
        counts.update(tuple(words[k : k + n]) for n in range(1, order + 1) for k in range(len(words) - n + 1))
    out = []
    for doc_id, text in rows:
        words, score, backs = tokens(text), 0.0, 0
        for k in range(len(words)):
            n, steps = min(order, k + 1), 0
            while n > 1 and counts[tuple(words[k - n + 1 : k + 1])] < least:
                n, steps = n - 1, steps + 1
            below = counts[tuple(words[k - n + 1 : k])] if n > 1 else total
            score += math.log(backoff**steps * counts[tuple(words[k - n + 1 : k + 1])] / below)
            backs += steps
        out.append((doc_id, len(words), backs, score, score / len(words) if words else None))
    return sorted(out, key=str)


def check(spark, rows, order=lm_scoring.ORDER, **options):
    df = spark.createDataFrame([(a, b, "clash") for a, b in rows], SCHEMA)
    columns = ("doc_id", "n_tokens", "n_backoffs", "log_score", "mean_log_score")
    got = sorted((tuple(r[c] for c in columns) for r in backoff_scores(df, order, **options).collect()), key=str)
    want = brute(rows, order)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[3] == pytest.approx(w[3], abs=1e-9) and (g[4] is None) == (w[4] is None)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_counting(spark, order, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PARTITION_GRAMS", 50)
    rng = random.Random(order)
    rows = [(k, " ".join(rng.choice(["a", "B", "b", "c", "dé", "e."]) for _ in range(rng.randrange(60)))) for k in range(50)]
    check(spark, rows, order, block_text=400)


def test_given_documents(spark):
    check(spark, [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()])


def test_edge_cases(spark):
    check(spark, [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "One two"), (5, "One two"), (None, "two one"), (6, "x y " * 90_000)])
    check(spark, [(1, None)])
    check(spark, [])


def test_planes_come_back():
    values = np.array([0, 1, 255, 256, 2**40 + 7], np.uint64)
    assert _values(_planes(values, 6), 6).tolist() == values.tolist()
    assert _sorted_values(_steps(values, 6), 6).tolist() == values.tolist()
    assert _sorted_values(_steps(values[:0], 6), 6).tolist() == []
