import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stratamart.llm import suffix_dedup
from stratamart.llm.suffix_dedup import without_repeats
from stratamart.llm.suffix_sort import SuffixSorter, difference_cover, repeated_windows

SCHEMA = "doc_id long, text string, key string"


def brute(rows, length):
    texts = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    met = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for doc_id, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if met[t[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((gone[1:] < gone[:-1]).sum())
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((doc_id, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, length):
    df = spark.createDataFrame([(a, b, "clash") for a, b in rows], SCHEMA)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r[c] for c in columns) for r in without_repeats(df, length).collect()), key=str)


def corpus(seed, n, letters):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(400)) for _ in range(4)]
    rows = []
    for k in range(n):
        text = ""
        for _ in range(rng.randrange(1, 4)):
            a = rng.randrange(300)
            part = list(rng.choice(base)[a : a + rng.randrange(20, 250)])
            part[rng.randrange(len(part))] = rng.choice("XYZé")
            text += "".join(part) + "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        rows.append((k, text))
    return rows


@pytest.mark.parametrize(("length", "letters"), [(40, "abcdefgh"), (64, "ab"), (200, "abcdefghijklmnop ")])
def test_against_counting_all_strings(spark, length, letters):
    rows = corpus(length, 60, letters)
    assert run(spark, rows, length) == brute(rows, length)


def test_split_anchors(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", 2)
    rows = corpus(8, 60, "abcdefgh")
    assert run(spark, rows, 64) == brute(rows, 64)


def test_long_texts_in_parts_and_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SCAN_BYTES", 150)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_BYTES", -1)
    rows = corpus(9, 40, "abcdefgh")
    assert run(spark, rows, 50) == brute(rows, 50)


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, rows, 200) == brute(rows, 200)


def test_edge_cases(spark):
    rows = [
        (1, None),
        (2, ""),
        (3, "short"),
        (4, "é" * 150),
        (5, "a" * 199),
        (6, "b" * 201),
        (7, "c" * 200),
        (None, "x" * 50 + "c" * 200),
        (8, "once " + "".join(chr(97 + k * k % 23) for k in range(260))),
        (9, "twice " + "".join(chr(97 + k * k % 19) for k in range(260))),
        (9, "twice " + "".join(chr(97 + k * k % 19) for k in range(260))),
        (10, "".join(chr(97 + k * 7 % 25) + str(k) for k in range(60_000))),
        (None, None),
    ]
    assert run(spark, rows, 200) == brute(rows, 200)
    assert run(spark, [], 200) == []


def test_cover_takes_every_pair_of_positions():
    for period in (8, 32, 64):
        cover, shift = difference_cover(period)
        for i in range(period):
            for d in range(period):
                s = (shift[d] - i) % period
                assert (i + s) % period in cover and (i + d + s) % period in cover


def test_suffixes_are_in_order_and_repeats_found():
    rng = random.Random(1)
    for _ in range(20):
        length = rng.choice([8, 20, 40, 200])
        base = ["".join(rng.choice(rng.choice(["ab", "abcdefghijkl"])) for _ in range(500)).encode() for _ in range(3)]
        strings = []
        for _ in range(rng.randrange(1, 25)):
            b, a = bytearray(rng.choice(base)), rng.randrange(200)
            b = b[a : a + rng.randrange(length, length + 200)]
            b[rng.randrange(len(b))] = rng.choice(b"Aab")
            strings.append(bytes(b))
        counts = [max(0, len(s) - length + 1) for s in strings]
        got = repeated_windows(strings, counts, length, bucket=rng.choice([50, 1 << 18]))
        met = Counter(s[k : k + length] for s, n in zip(strings, counts, strict=True) for k in range(n))
        for s, n, flags in zip(strings, counts, got, strict=True):
            assert [met[s[k : k + length]] > 1 for k in range(n)] == flags.tolist()
        sorter = SuffixSorter(strings, 200)
        every = np.concatenate([b + np.arange(n) for b, n in zip(sorter.bases, counts, strict=True)]).astype(np.int64)
        text = (b"\xff" * 16).join(strings) + b"\xff" * 400
        shown = [text[k : k + 200] for k in sorter.sort(every)[0]]
        assert shown == sorted(shown)
