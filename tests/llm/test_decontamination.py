import random
import re
from collections import Counter

import numpy as np

from stratamart.llm.decontamination import UNITS, contaminated, without_contaminated
from stratamart.llm.textblocks import RangeHash

ITEM = "Sara bought 12 kg of apples for 30 dollars and sold 5 kg to her friend Tom at 4 dollars a kilo today"
SCHEMA = "doc_id long, text string, item_id string"


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(a, b, "clash") for a, b in docs], SCHEMA)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((r.doc_id, r.item_id, r.item_windows, r.found_windows, r.verbatim) for r in contaminated(d, i, **options).collect())


def canonical(text):
    """Canonical words of ASCII text, and slot values."""
    out, last = [], 0
    for m in re.finditer(r"(?:[0-9A-Za-z\x80-￿]|(?<=[0-9])[.,](?=[0-9]))+", text):
        word, gap = m[0], text[last : m.start()]
        opens = not out or re.search(r"[.!?:;\n]", gap)
        last = m.end()
        lower = re.sub("[A-Z]", lambda c: c[0].lower(), word)
        if re.search("[0-9]", word):
            out.append(("#", lower))
        elif re.match("[A-Z]", word) and not opens:
            out.append(("@", lower))
        elif lower in UNITS:
            out.append(("%", lower))
        else:
            out.append((lower, None))
    return out


def order(value):
    """Of values that are met equally often, that with the smallest hash counts."""
    data = np.frombuffer(value.encode(), np.uint8)
    return int(RangeHash(data).of(np.array([0]), np.array([len(data)])).view(np.int64)[0])


def agreeing(hits):
    """Windows that give each value of the item the value that most windows of the alignment give it."""
    met = Counter(p for _, _, ps in hits for p in ps)
    usual = {}
    for (own, value), n in sorted(met.items(), key=lambda x: (-x[1], order(x[0][1]))):
        usual.setdefault(own, value)
    return {(place, kind) for place, kind, ps in hits if all(usual[a] == b for a, b in ps)}


def brute(docs, items, window=5, literals=3, similarity=0.8, passage=13):
    def grams(text):
        """Position, kind, window, values of its slots: every window as written, and templates with slots."""
        words = canonical(text or "")
        for k in range(len(words) - window + 1):
            part = words[k : k + window]
            values = tuple(v for _, v in part if v is not None)
            yield k, "written", tuple(v or w for w, v in part), ()
            if values and window - len(values) >= literals:
                yield k, "template", tuple(w for w, _ in part), values

    def usable_places(text):
        words = canonical(text or "")
        return {k for k in range(len(words) - window + 1) if sum(v is None for _, v in words[k : k + window]) >= literals}

    of_items = [(i, list(grams(t)), usable_places(t)) for i, t in items if i is not None]
    index = {}
    for n, (_, own, _) in enumerate(of_items):
        for place, kind, gram, slots in own:
            index.setdefault((kind, gram), []).append((n, place, slots))
    out = []
    for doc_id, text in docs:
        if doc_id is None:
            continue
        aligned = {}
        for k, kind, gram, values in grams(text):
            for n, place, slots in index.get((kind, gram), []):
                aligned.setdefault(n, {}).setdefault(k - place, set()).add((place, kind, tuple(zip(slots, values, strict=True))))
        for n, shifts in aligned.items():
            item_id, own, usable = of_items[n]
            kept = [agreeing(hits) for hits in shifts.values()]
            found = {place for hits in kept for place, _ in hits}
            written = {place for hits in kept for place, kind in hits if kind == "written"}
            longest = max(sum(kind == "written" for _, kind in hits) for hits in kept)
            total = len({place for place, *_ in own})
            in_template = len(found & usable)
            if (
                len(found) >= similarity * total
                or (2 * len(usable) >= total and in_template >= similarity * len(usable))
                or in_template >= passage
                or longest >= passage - window + 1
            ):
                out.append((doc_id, item_id, total, len(found), written == found))
    return sorted(out)


def test_copies_and_other_parameters(spark):
    other = ITEM.replace("12", "17").replace("30", "55").replace("Sara", "Sara").replace("Tom", "Ann").replace("kg", "lb").replace("dollars", "euros")
    torn = other.replace("5 lb", "5 oz")
    docs = [
        (1, "Some words before it. " + ITEM + ". And more after."),
        (2, other),
        (3, "apples for her friend and nothing else here"),
        (4, ITEM.upper()),
        (5, torn),
        (6, ITEM[:40]),
    ]
    got = run(spark, docs, [(7, ITEM)])
    assert got == brute(docs, [(7, ITEM)])
    assert [(r[0], r[-1]) for r in got][:2] == [(1, True), (2, False)]
    assert (4, True) in [(r[0], r[-1]) for r in got]
    assert not {3, 6} & {r[0] for r in got}


def test_copies_with_few_plain_words_and_in_any_letter_case(spark):
    names = "Today Anna Berg and Carl Dorn met Emil Frey and Gina Hahn at Lake Iser with Jonas Kern"
    items = [(1, "What is 12 + 35 * 4?"), (2, "Compute 3 x 4 + 5 x 6"), (3, names), (4, "12 13 14 15 16 17 18")]
    docs = [(1, "so: What is 12 + 35 * 4? It is"), (2, "Compute 3 x 4 + 5 x 6"), (3, names), (4, names.lower()), (5, names.upper())]
    docs += [(6, "Compute 7 x 8 + 5 x 6"), (7, "Paul Roth and Rosa Senn met Timo Ulm"), (8, "0 12 13 14 15 16 17 18 9")]
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    assert [(r[0], r[1]) for r in got] == [(1, 1), (2, 2), (3, 3), (4, 3), (5, 3), (8, 4)]


def test_a_few_windows_of_a_template_are_not_an_item(spark):
    item = "Anna Berg and Carl Dorn met Emil Frey while the cat sat on Lake Iser with Jonas Kern and Lena Maas in Nord Oster"
    docs = [(1, "there the cat sat on Mount Everest with us"), (2, item)]
    got = run(spark, docs, [(1, item)])
    assert [r[0] for r in got] == [2] and got == brute(docs, [(1, item)])


def test_planted_contradictions(spark):
    rng = random.Random(5)
    plain = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmn"]
    items, docs = [], []
    for k in range(12):
        words = [rng.choice(plain) if rng.random() < 0.8 else rng.choice(["5", "17", "kg", "Tom", "Ann", "miles"]) for _ in range(40)]
        items.append((k, " ".join(words)))
        for n in range(4):
            other = {"5": "8", "17": "3", "Tom": "Eva", "Ann": "Ida", "kg": "lb", "miles": "feet"}
            edited = [other.get(w, w) if n % 2 else w for w in words]
            for place in rng.sample(range(40), 3 * (n // 2)):
                edited[place] = rng.choice(["6", "Udo", "oz", "5"])
            docs.append((4 * k + n, " ".join(edited)))
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    assert {(k, k // 4) for k in range(48) if k % 4 < 2} <= {r[:2] for r in got}


def test_inconsistent_slots_do_not_count(spark):
    item = "the 5 red cars met the 5 blue cars near the 5 old green trees by the 5 new lakes"
    same, torn = item.replace("5", "8"), "the 1 red cars met the 2 blue cars near the 3 old green trees by the 4 new lakes"
    docs = [(1, same), (2, torn)]
    assert [r[0] for r in run(spark, docs, [(1, item)])] == [1]
    assert run(spark, docs, [(1, item)]) == brute(docs, [(1, item)])


def test_one_slot_that_differs_costs_its_windows_only(spark):
    plain = [f"word{chr(97 + k)}{chr(97 + j)}" for k in range(9) for j in range(6)]
    item = " ".join([*plain[:10], "5", *plain[10:30], "5", *plain[30:45], "5", *plain[45:]])
    edited = " ".join(w if k != 31 else "6" for k, w in enumerate(item.split()))
    docs = [(1, item), (2, edited), (3, item.replace("5", "8")), (4, edited.replace("5", "8"))]
    got = run(spark, docs, [(1, item)])
    assert [(r[0], r[3]) for r in got] == [(1, 53), (2, 48), (3, 53), (4, 48)]
    assert [r[4] for r in got] == [True, True, False, False]


def test_long_passages_of_longer_items(spark):
    item = " ".join(f"word{chr(97 + k)}x" for k in range(26)) + " " + " ".join(f"then{chr(97 + k)}y" for k in range(26))
    docs = [(1, " ".join(item.split()[10:23]) + " and on"), (2, " ".join(item.split()[10:22]) + " and on")]
    assert [r[0] for r in run(spark, docs, [(1, item)])] == [1]
    assert run(spark, docs, [(1, item)]) == brute(docs, [(1, item)])


def test_given_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id % 3 = 0").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").select("item_id", "text").collect()]
    got = run(spark, docs, items)
    assert got and got == brute(docs, items)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (None, ITEM), (3, (ITEM + ". ") * 3000), (4, ITEM), (4, ITEM)]
    items = [(1, ITEM), (1, ITEM), (2, None), (None, ITEM), (3, "one two"), (4, "12 13 14 15 16 17 18")]
    assert {r[:2] for r in run(spark, docs, items)} == {(3, 1), (4, 1)}
    assert {r[:2] for r in run(spark, [(1, "x 12 13 14 15 16 17 18")], items)} == {(1, 4)}
    assert run(spark, [], items) == [] and run(spark, docs, []) == []


def test_filtering_goes_by_text_and_keeps_all_columns(spark):
    rows = [(1, ITEM, "a"), (2, "clean text", "b"), (None, ITEM, "c"), (None, "clean too", "d"), (3, None, "e"), (3, ITEM, "f"), (3, "clean", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, text_digest string")
    out = without_contaminated(df, spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert out.columns == df.columns and sorted(r.text_digest for r in out.collect()) == ["b", "d", "e", "g"]
