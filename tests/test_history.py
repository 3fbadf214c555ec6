"""Dimension histories from loads in any order."""

import random
from itertools import permutations

import pytest

from stratamart.model import CUSTOMERS, DIMENSIONS, Lake
from stratamart.operators.history import insert_states, last_of_day
from stratamart.plans import gold
from stratamart.sinks.tables import overwrite
from stratamart.sources.tables import scan_table
from tests.frames import day

SPEC = DIMENSIONS[CUSTOMERS]


def customers(spark, rows):
    return spark.createDataFrame(list(rows), "ClienteID bigint, Nome string, CidadeID int")


def history(spark, lake):
    rows = scan_table(spark, lake.table("gold", CUSTOMERS)).collect()
    assert len({r.SK_Cliente for r in rows}) == len(rows)
    return sorted(
        (r.ClienteID, str(r.data_inicio), str(r.data_fim), r.Nome or "-", r.CidadeID or 0, r.registro_ativo) for r in rows
    )


def load(spark, lake, loads, first=True):
    for date, rows in loads:
        overwrite(customers(spark, rows), lake.table("silver", CUSTOMERS))
        if first:
            gold.build_dimension(spark, lake, SPEC, date, remember=True)
        else:
            gold.update_dimension(spark, lake, SPEC, date, remember=True)
        first = False


def plain(loads):
    """The history of loads in their order, by hand: values of a key until another one is seen."""
    states = {}
    for date, rows in loads:
        for key, *values in rows:
            states.setdefault(key, {})[date] = tuple(values)
    out = []
    for key, known in states.items():
        runs = []
        for date in sorted(known):
            if not runs or runs[-1][1] != known[date]:
                runs.append((date, known[date]))
        for k, (date, (name, city)) in enumerate(runs):
            end = runs[k + 1][0] if k + 1 < len(runs) else "9999-12-31"
            out.append((key, date, end, name or "-", city or 0, int(k + 1 == len(runs))))
    return sorted(out)


LOADS = [
    ("2020-01-01", [(1, "a", 1), (2, "b", 1), (4, "d", None)]),
    ("2020-02-01", [(1, "b", 1), (2, "b", 1), (3, "c", 1), (4, "d", None)]),
    ("2020-03-01", [(1, "a", 1), (3, "x", 2)]),
    ("2020-04-01", [(1, "a", 1), (2, "b", 1), (3, "c", 1), (4, "d", 4)]),
]


@pytest.mark.parametrize("order", random.Random(1).sample(list(permutations(range(4))), 4) + [(3, 2, 1, 0)])
def test_any_order_gives_the_ordered_history(spark, tmp_path, order):
    lake = Lake.under(str(tmp_path / "lake"))
    load(spark, lake, [LOADS[k] for k in order])
    assert history(spark, lake) == plain(LOADS)


def test_a_backdated_value_ends_where_the_old_one_was_seen_again(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    load(spark, lake, [("2020-01-01", [(1, "a", 1)]), ("2020-03-01", [(1, "a", 1)]), ("2020-02-01", [(1, "b", 1)])])
    keys = {str(r.data_inicio): r.SK_Cliente for r in scan_table(spark, lake.table("gold", CUSTOMERS)).collect()}
    assert set(keys) == {"2020-01-01", "2020-02-01", "2020-03-01"} and keys["2020-01-01"] == 1
    # Repeating the load changes nothing, nor does one that was known.
    before = history(spark, lake)
    load(spark, lake, [("2020-02-01", [(1, "b", 1)]), ("2020-01-01", [(1, "a", 1)])], first=False)
    assert history(spark, lake) == before


def test_loads_that_are_not_remembered_stay_in_order(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    overwrite(customers(spark, [(1, "a", 1)]), lake.table("silver", CUSTOMERS))
    gold.build_dimension(spark, lake, SPEC, "2020-02-01")
    with pytest.raises(ValueError, match="before"):
        gold.update_dimension(spark, lake, SPEC, "2020-01-01")
    with pytest.raises(ValueError, match="not remembered"):
        gold.update_dimension(spark, lake, SPEC, "2020-03-01", remember=True)


def changes(spark, rows):
    return spark.createDataFrame(
        [(k, name, city, None if at is None else day(at), n) for k, name, city, at, n in rows],
        "ClienteID bigint, Nome string, CidadeID int, quando date, seq bigint",
    )


def test_a_feed_in_pieces_and_out_of_order(spark, tmp_path):
    rng = random.Random(7)
    # Key 1 has a third of all changes.
    rows = [
        (1 if i % 3 == 0 else 2 + i % 20, rng.choice("ab"), rng.choice([1, None]), f"2021-{1 + i % 12:02d}-{1 + rng.randrange(28):02d}", i)
        for i in range(300)
    ]
    first = ("2020-06-01", [(k, "a", 1) for k in range(1, 12)])
    states = {}
    for k, name, city, at, n in sorted(rows, key=lambda r: r[4]):
        states[k, at] = (name, city)
    expected = plain([first] + [(at, [(k, *v)]) for (k, at), v in states.items()])
    lake = Lake.under(str(tmp_path / "lake"))
    load(spark, lake, [first])
    # A day is fed as a whole, the days in any order.
    days = sorted({r[3] for r in rows})
    rng.shuffle(days)
    for part in (days[::2], days[1::2]):
        feed = changes(spark, [r for r in rows if r[3] in part] + [(None, "z", 1, part[0], 1), (5, "z", 1, None, 1)])
        gold.apply_changes(spark, lake, SPEC, feed, "quando", "seq", remember=True)
    assert history(spark, lake) == expected


def test_last_of_day_and_empty_feeds(spark):
    feed = changes(spark, [(1, "a", 1, "2021-01-01", 2), (1, "b", None, "2021-01-01", 1), (1, "b", 1, "2021-01-02", 1)])
    found = {(r.ClienteID, str(r.data_inicio), r.Nome) for r in last_of_day(feed, SPEC, "quando", "seq").collect()}
    assert found == {(1, "2021-01-01", "a"), (1, "2021-01-02", "b")}
    dimension = spark.createDataFrame(
        [(1, "a", 1, 1, day("2020-01-01"), day("9999-12-31"), 1)],
        "ClienteID bigint, Nome string, CidadeID int, SK_Cliente bigint, data_inicio date, data_fim date, registro_ativo int",
    )
    none = last_of_day(changes(spark, []), SPEC, "quando", "seq")
    assert insert_states(dimension, none, SPEC).collect() == dimension.collect()
