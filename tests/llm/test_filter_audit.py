import re
from collections import Counter
from itertools import permutations

import pytest

from stratamart.llm.filter_audit import audit, failed_filters
from stratamart.llm.term_matrix import term_matrix

LONG = "one two three four five six seven eight nine ten " * 30
ROWS = [
    (1, "alpha beta alpha", "a"),
    (2, "alpha beta alpha", "b"),
    (2, "alpha beta alpha", "b"),
    (3, None, "a"),
    (4, "", None),
    (5, " \t\n\x0b\x0c\r ", ""),
    (6, LONG, "a"),
    (7, " ".join(f"w{i}" for i in range(250)), "a"),
    (8, " ".join(f"w{i}" for i in range(250)) + " x#y", "a"),
    (9, " ".join(f"W{i}" for i in range(250)), "b"),
    (10, "é ß\xa0ü 日本 A", "b"),
    (11, LONG, "a"),
    (None, LONG, "c"),
    (None, LONG, "c"),
    (12, "word " * 60000 + "end", "c"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (6, 0, 1), (11, 1, None), (None, 1, 1), (99, 1, 1)]


def frames(spark, rows=ROWS, labels=LABELS):
    docs = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "doc_id bigint, text string, source string, n long, part string")
    return docs.repartition(3), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def conditions(rows):
    out = []
    for doc_id, text, _ in rows:
        text, ws = text or "", words(text)
        smaller = [d for d, t, _ in rows if (t or "") == text and d is not None and doc_id is not None and d < doc_id]
        fails = [
            len(ws) < 200, 100 * len(set(ws)) < 50 * len(ws), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            bool(re.search(r"[#$%&*|]", text)), bool(smaller),
        ]
        out.append({letter for letter, f in zip("ABCDE", fails, strict=True) if f})
    return out


def brute(rows, labels):
    """Filters applied in turn to the documents themselves, order by order."""
    fails = conditions(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out, shapley = {}, Counter()
    for part in {s or "" for *_, s in rows}:
        mine = [k for k, r in enumerate(rows) if (r[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = set(mine)
            for step, f in enumerate(order, 1):
                gone = {k for k in left if f in fails[k]}
                failing = {k for k in mine if f in fails[k]}
                shapley[part, f] += len(gone)
                out[part, order, step] = [
                    len(left - gone), len(gone), len(failing - gone), sum(fails[k] == {f} for k in mine),
                    sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone),
                ]
                left -= gone
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_every_order_against_applying_it(spark):
    docs, labels = frames(spark)
    found = audit(docs, labels).collect()
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert len(found) == 4 * 120 * 5
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in names) for r in found} == brute(ROWS, LABELS)


def test_matrix_counts_every_word(spark, monkeypatch):
    import stratamart.llm.term_matrix as module

    # Small shards, so that words of several of them have to agree on their ids.
    monkeypatch.setattr(module, "SHARD_BYTES", 64)
    docs, _ = frames(spark)
    dictionary, matrix = term_matrix(docs, ["doc_id", "n"])
    names = {r.term_id: r.term for r in dictionary.collect()}
    vocabulary = {w for _, text, _ in ROWS for w in words(text)}
    assert dictionary.count() == len(names) and sorted(names.values()) == sorted(vocabulary)
    shards = matrix.collect()
    assert len(shards) > 8
    seen = {}
    for s in shards:
        assert len(s.indptr) == len(s.rows) + 1
        for row, a, b in zip(s.rows, s.indptr, s.indptr[1:], strict=False):
            seen[row.n] = {names[c]: n for c, n in zip(s.columns[a:b], s.counts[a:b], strict=True)}
    assert seen == {i: dict(Counter(words(text))) for i, (_, text, _) in enumerate(ROWS)}


def test_rows_of_the_matrix_are_blocks_of_a_shard(spark, monkeypatch):
    import stratamart.llm.term_matrix as module

    monkeypatch.setattr(module, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(module, "BLOCK_BYTES", 500)
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(i % 40)) for i in range(1200)] + [None, "long " * 300 + "w1", "end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    dictionary, matrix = term_matrix(docs, ["doc_id"])
    names = {r.term_id: r.term for r in dictionary.collect()}
    assert sorted(names.values()) == sorted({w for t in texts for w in words(t)})
    blocks = matrix.collect()
    shards = {b.shard for b in blocks}
    assert len(shards) > 3 and len(blocks) > 10 * len(shards)
    seen = {}
    for block in blocks:
        assert len(block.rows) == 1 or sum(len(texts[r.doc_id] or "") for r in block.rows) <= 500
        assert len(block.indptr) == len(block.rows) + 1
        assert len(block.columns) == len(block.counts) == block.indptr[-1]
        for row, a, b in zip(block.rows, block.indptr, block.indptr[1:], strict=False):
            seen[row.doc_id] = {names[c]: n for c, n in zip(block.columns[a:b], block.counts[a:b], strict=True)}
    assert seen == {i: dict(Counter(words(t))) for i, t in enumerate(texts)}


def test_copies_of_one_text_in_a_third_of_all_rows(spark):
    rows = [(i, LONG if i % 3 == 0 else f"text {i}", "s") for i in range(600)]
    docs, labels = frames(spark, rows, [])
    got = {r.doc_id: r.failed for r in failed_filters(docs).collect()}
    assert {d for d, f in got.items() if f & 16} == {i for i in range(3, 600, 3)}
    assert all(r.kept + r.removed <= 600 and r.good_lost == 0 for r in audit(docs, labels).collect())


@pytest.mark.parametrize("empty", ["rows", "labels"])
def test_empty_tables(spark, empty):
    docs, labels = frames(spark, ROWS if empty == "labels" else [], LABELS if empty == "rows" else [])
    found = audit(docs, labels).collect()
    assert len(found) == (0 if empty == "rows" else 2400)
    assert not sum(r.good_lost + r.toxic_lost for r in found)
