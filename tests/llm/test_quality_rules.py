import math
import random
import re
from collections import Counter

import pytest

from stratamart.llm.quality_rules import COMMON, judged

SCHEMA = "doc_id long, text string, lang string, n_words string"
BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
SPACE = " \t\n\v\f\r"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(k, k + 3)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    base = (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))
    return (*base, len(words) < 50 or 100 * len(covered) > 50 * len(words)), words, text


def histogram(words, text, lang):
    wide = len(text.encode()) - len(text)
    white = sum(c in SPACE for c in text)
    known = [
        white,
        sum("A" <= c <= "Z" for c in text),
        sum("0" <= c <= "9" for c in text),
        sum(c in ".,;:!?'\"()-" for c in text),
        sum(c in "#*$%&|<>" for c in text),
        wide,
    ]
    classes = [*known, max(0, len(text) - sum(known))]
    return classes, [words.count(w) for w in COMMON[lang]] if lang in COMMON else None


def distance(one, two):
    if not one or not two or not sum(one) or not sum(two):
        return 0.0
    out = 0.0
    for a, b in zip(one, two, strict=True):
        p, q = a / sum(one), b / sum(two)
        out += sum(x * math.log2(2 * x / (p + q)) for x in (p, q) if x) / 2
    return math.sqrt(max(0, out))


def brute(rows):
    found = [(doc_id, lang if lang in COMMON else "other", *counts(text)) for doc_id, text, lang in rows]
    usual = {}
    for _, lang, base, words, text in found:
        if not base[-1]:
            a, b = histogram(words, text, lang)
            have = usual.setdefault(lang, ([0] * 7, [0] * 16, 0))
            classes = [x + y for x, y in zip(have[0], a, strict=True)]
            usual[lang] = (classes, b and [x + y for x, y in zip(have[1], b, strict=True)], have[2] + len(words))
    out = []
    for doc_id, lang, base, words, text in found:
        a, b = histogram(words, text, lang)
        classes, common, n = usual.get(lang, (None, None, 0))
        near = (len(text) < 300 or distance(a, classes) <= 0.25) and (not b or sum(b) < 20 or distance(b, common) <= 0.6)
        if b and common and sum(common) and len(words) * sum(common) >= 20 * n:
            others = [sum(common), n - sum(common)]
            most = distance([0, 1], others)
            near = near and (most == 0 or distance([sum(b), len(words) - sum(b)], others) / most <= 0.6)
        out.append((doc_id, *base, not base[-1] and near))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    return sorted((tuple(r[c] for c in BASE) for r in judged(df).collect()), key=str)


def corpus():
    rng = random.Random(2)
    vocabulary = {lang: [*words, *(w * 2 + "x" for w in words), "Über.", "12"] for lang, words in COMMON.items()}
    rows = []
    for k in range(80):
        lang = rng.choice([*COMMON, None, "it"])
        words = [rng.choice(vocabulary[lang or "en"] if lang in COMMON else vocabulary["en"]) for _ in range(rng.randrange(20, 300))]
        if k % 9 == 0:
            words = [w + "***" for w in words]
        if k % 7 == 0:
            words = words[:20] * 9
        if k % 11 == 0:
            words = ["the"] * 40 + words[:30]
        text = "".join(w + rng.choice([" ", " ", "\n", " \t"]) for w in words)
        rows.append((k, text, lang))
    return rows


def test_against_counting(spark):
    rows = corpus()
    got = run(spark, rows)
    assert got == brute(rows)
    assert len({r[-1] for r in got}) == 2


def test_long_texts_without_common_words(spark):
    rng = random.Random(4)
    prose = lambda lang, n: " ".join(rng.choice([*COMMON[lang], *(f"{chr(97 + k)}ord" for k in range(24))]) for _ in range(n))
    names = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(n))
    rows = [(k, prose(lang, 200), lang) for k, lang in enumerate(["en", "fr", "de"] * 14)]
    rows += [(50, names(400), "en"), (51, names(200) + " the of and to in", "en"), (52, prose("fr", 400), "de"), (53, names(60) , "it")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    out = judged(df).collect()
    got, kept = ({r.doc_id: r[c] for r in out} for c in ("word_distance", "kept"))
    assert run(spark, rows) == brute(rows)
    assert not any(kept[k] for k in (50, 51, 52)) and all(kept[k] for k in [*range(40), 53])
    assert got[50] == pytest.approx(1) and got[51] > 0.6
    assert all(got[k] < 0.5 for k in range(40))
    assert got[53] is None


def test_given_documents(spark):
    columns = ("doc_id", "text", "lang")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*columns).collect()]
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    rows = [
        (1, None, None),
        (2, "", "en"),
        (3, " \n\t", "en"),
        (4, "a b", "en"),
        (5, "x\nx\n\n\n x\nx", "xx"),
        (6, "one two three one two three", None),
        (7, "a a a a", "de"),
        (8, "word other thing " * 20_000, "en"),
        (9, " ".join(f"w{k}" for k in range(60_000)), "en"),
        (None, " ".join(f"v{k}" for k in range(60)), "en"),
        (10, " ".join(f"u{k}" for k in range(60)), "en"),
        (10, " ".join(f"u{k}" for k in range(60)), "en"),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_only_built_in_functions(spark):
    plan = judged(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_distance_is_one_without_overlap(spark):
    from pyspark.sql import functions as F

    from stratamart.llm.quality_rules import distance as js

    row = spark.range(1).select(js(F.array(F.lit(1), F.lit(0)), F.array(F.lit(0), F.lit(5))).alias("d")).first()
    assert row.d == pytest.approx(1)
