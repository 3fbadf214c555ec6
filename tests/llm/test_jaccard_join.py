import random
import re

import numpy as np
import pytest

from stratamart.llm import jaccard_join
from stratamart.llm.jaccard_join import one_of_each_group, similar_documents, tile_links

SCHEMA = "doc_id long, text string, component_id string"


def shingles(text, n):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def brute(rows, n, percent):
    sets = [shingles(text, n) for _, text in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    out = []
    for k, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[k] and rows[j][0] is not None]
        out.append((doc_id, len(sets[k]), min(ids, default=None)))
    return sorted(out, key=str)


def corpus(seed, sizes, copies, edits):
    """Random texts and copies with some words changed."""
    rng = random.Random(seed)
    rows = []
    for size in sizes:
        base = [f"w{rng.randrange(400)}" for _ in range(size)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(edits + 1)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
            rows.append(" ".join(words))
    return list(enumerate(rows))


def run(spark, rows, n, percent):
    df = spark.createDataFrame([(a, b, "clash") for a, b in rows], SCHEMA)
    found = similar_documents(df, n, percent).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_against_all_pairs(spark, n, percent):
    rows = corpus(3, [4, 9, 12, 20, 40, 60, 100, 200, 350], 9, 6)
    assert run(spark, rows, n, percent) == brute(rows, n, percent)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_keys_of_similar_sets_meet(n, percent):
    """Sets at the limit share a key whatever their size; long ones emit keys in proportion."""
    rng = np.random.default_rng(n)
    for size in [*range(1, 60), 150, 400, 3000, 30_000]:
        for _ in range(20 if size < 100 else 2):
            common = size * percent // 100
            one = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
            two = np.sort(one[rng.permutation(len(one))[: max(common, 1)]])
            assert 100 * len(two) < percent * len(one) or len(
                set(keys_of(one, percent)) & set(keys_of(two, percent))
            )
        assert len(keys_of(one, percent)) <= 20 + 2 * size


def keys_of(s, percent):
    band, tops = jaccard_join.bands(np.array([len(s)]), percent)
    return jaccard_join._keys(s, percent, int(band[0]), tops).tolist()


def test_large_groups_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CELL_SETS", 5)
    rows = corpus(4, [40, 46, 120], 25, 3)
    assert run(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_edge_cases(spark):
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "One two"),
        (5, "one  TWO"),
        (6, "two one"),
        (7, "É a"),
        (8, "é a"),
        (None, "One two"),
        (None, "nobody else has this text"),
        (9, "long " * 50_000),
        (9, "long " * 50_000),
        (10, "long\n" * 9),
    ]
    assert run(spark, rows, 3, 90) == brute(rows, 3, 90)
    assert run(spark, [], 3, 90) == []


def test_one_document_of_each_group(spark):
    text = " ".join(f"w{k}" for k in range(60))
    df = spark.createDataFrame([(3, text, "a"), (1, text + " more", "b"), (2, "other", "c"), (None, text, "d")], SCHEMA)
    assert sorted(r.component_id for r in one_of_each_group(df).collect()) == ["b", "c"]


def test_rows_count_not_ids(spark):
    text, other = (" ".join(f"{c}{k}" for k in range(60)) for c in "wv")
    rows = [
        (1, text, "a"), (1, text, "a"), (1, text, "b"), (2, text, "c"), (2, other, "d"), (2, other + " more", "e"),
        (None, other, "f"), (None, "nobody else", "g"), (None, "nobody else", "h"), (7, None, "i"), (7, "", "j"), (None, " ", "k"),
    ]
    got = sorted(r.component_id for r in one_of_each_group(spark.createDataFrame(rows, SCHEMA)).collect())
    assert len(got) == 6 and got[0] in "ab" and got[1] in "de" and got[2] in "gh" and got[3:] == ["i", "j", "k"]


def test_bitmaps_keep_what_is_similar(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (100, 130, 900, 1100)]
    sets = [np.unique(np.concatenate([b[k % 9 :], rng.integers(0, 1 << 63, k % 13, dtype=np.uint64)])) for b in base for k in range(30)]
    sizes = np.array([len(s) for s in sets])
    links = jaccard_join.likely_links(sizes, [jaccard_join.bitmap(s) for s in sets], np.zeros(len(sets), np.int64), 80)
    group = list(range(len(sets)))
    for a, b in links:
        group = [group[b] if g == group[a] else g for g in group]
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j])):
                assert group[i] == group[j]
    assert len(set(group)) >= 4


def test_large_groups_are_cut_by_bitmaps(spark, monkeypatch):
    for name in ("CELL_SETS", "BITMAP_CELL_SETS"):
        monkeypatch.setattr(jaccard_join, name, 5)
    rows = corpus(4, [40, 46, 120], 25, 3)
    assert run(spark, rows, 3, 90) == brute(rows, 3, 90)
    assert run(spark, rows, 5, 80) == brute(rows, 5, 80)


def test_tile_links_connect_what_is_similar():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[k % 7 :], rng.integers(0, 1 << 63, k % 11, dtype=np.uint64)])) for k in range(40)]
    links = tile_links(sets, np.zeros(40, np.int64), 90)
    group = list(range(40))
    for a, b in links:
        assert 100 * len(np.intersect1d(sets[a], sets[b])) >= 90 * len(np.union1d(sets[a], sets[b]))
        group = [group[b] if g == group[a] else g for g in group]
    for i in range(40):
        for j in range(i):
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 90 * len(np.union1d(sets[i], sets[j])):
                assert group[i] == group[j]
