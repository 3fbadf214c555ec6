import zlib

import numpy as np
import pytest

from stratamart.llm.quality_classifier import BITS, SHORT, Model, _features, fit, score
from stratamart.llm.textblocks import RangeHash, flat, mix

import pyarrow as pa

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(given):
    docs, labels = given
    rows = score(docs, fit(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 40
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    good = [r for r in held if r.quality == 1]
    bad = [r for r in held if r.quality == 0]
    assert sum(r.predicted for r in good) >= 0.98 * len(good)
    assert sum(1 - r.predicted for r in bad) >= 0.7 * len(bad)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_fit_is_the_same_again(given):
    docs, labels = given
    one, two = fit(docs, labels, sample=40), fit(docs.repartition(7), labels.repartition(3), sample=40)
    assert one.bias == two.bias and np.array_equal(one.weights, two.weights)


def test_held_out_labels_are_not_used(given):
    docs, labels = given
    other = labels.selectExpr("doc_id", "if(crc32(cast(doc_id AS string)) % 5 = 0, 1 - quality, quality) AS quality")
    assert np.array_equal(fit(docs, labels, sample=30).weights, fit(docs, other, sample=30).weights)


def test_features_of_each_text_alone():
    texts = ["one two three", "", "ab", "One\ttwo", "é é"]
    data, offsets = flat(pa.array([*texts, None]))
    shift = np.uint64(64 - BITS)
    for k, text in enumerate(texts):
        got = [h[s[k] : s[k + 1]][ok[s[k] : s[k + 1]]].tolist() for h, ok, s in _features(data, offsets)]
        raw = text.encode()
        runs = [int.from_bytes(raw[j : j + SHORT], "little") * 2654435761 % 2**32 >> (32 - BITS) for j in range(len(raw) - 3)]
        words = [np.frombuffer(w.encode(), np.uint8) for w in text.lower().split()]
        hashes = np.array([RangeHash(w).of(np.array([0]), np.array([len(w)]))[0] for w in words], np.uint64)
        assert got[0] == runs
        assert got[1] == (hashes >> shift).tolist()
        assert got[2] == (mix(hashes[:-1] * np.uint64(3) + hashes[1:]) >> shift).tolist()


def test_edge_cases(spark):
    model = Model(np.full(1 << BITS, 0.5, np.float32), -1.0)
    docs = spark.createDataFrame(
        [(1, None, 2.0), (2, "", 2.0), (3, "word " * 300_000, 2.0), (4, "a b", 2.0), (4, "a b", 2.0), (None, "a b", 2.0)],
        "doc_id long, text string, score double",
    )
    got = {(r.doc_id, round(r.score, 9), r.held_out) for r in score(docs, model).collect()}
    none, some = 1 / (1 + np.e), 1 / (1 + np.exp(0.5))
    ids = {k: zlib.crc32(str(k).encode()) % 5 == 0 for k in range(5)}
    assert got == {
        (1, round(none, 9), ids[1]),
        (2, round(none, 9), ids[2]),
        *((k, round(some, 9), ids[k]) for k in (3, 4)),
        (None, round(some, 9), False),
    }
    assert score(docs, model).count() == 6
    assert score(docs.limit(0), model).count() == 0


def test_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1), (1, 7)], "doc_id long, quality int")
    assert [r.score for r in score(docs, fit(docs, labels)).collect()] == [0.5]


def test_conflicting_labels_and_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "e f g h"), (2, "i j"), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 1)], "doc_id long, quality int")
    assert score(docs, fit(docs, labels)).count() == 4


def test_accepted_sends_only_texts_to_python(spark, given):
    from stratamart.llm.quality_classifier import accepted

    docs, labels = given
    model = fit(docs, labels, sample=40)
    kept = accepted(docs, model)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan
    assert kept.columns == docs.columns
    want = score(docs, model).filter("predicted = 1").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(r.doc_id for r in want)
    rows = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "", "y")], "doc_id long, text string, lang string")
    assert accepted(rows, model).count() == (3 if 1 / (1 + np.exp(-model.bias)) >= 0.3 else 0)
