import random
from datetime import date

import pytest

from stratamart.model import Dimension
from stratamart.operators.dimensions import first_load, merge_changes
from tests.frames import day

SPEC = Dimension("clientes", "ClienteID", "SK_Cliente")
SCHEMA = "ClienteID bigint, Nome string, CidadeID int"
OPEN = day("9999-12-31")


def extract(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def versions(df):
    return sorted(
        (r.ClienteID, r.SK_Cliente, r.Nome, r.CidadeID, str(r.data_inicio), str(r.data_fim), r.registro_ativo)
        for r in df.collect()
    )


def test_first_load(spark):
    out = first_load(extract(spark, [(7, "a", 1), (3, "b", None)]), SPEC, "2024-01-01")
    assert out.columns == ["ClienteID", "Nome", "CidadeID", "SK_Cliente", "data_inicio", "data_fim", "registro_ativo"]
    assert versions(out) == [
        (3, 1, "b", None, "2024-01-01", "9999-12-31", 1),
        (7, 2, "a", 1, "2024-01-01", "9999-12-31", 1),
    ]


def test_load_date_defaults_to_today(spark):
    today = spark.sql("select current_date()").first()[0]
    assert first_load(extract(spark, [(1, "a", 1)]), SPEC).first().data_inicio >= today


def test_merge(spark):
    old = first_load(
        extract(spark, [(1, "same", 1), (2, "before", 1), (3, "x", None), (4, "x", 4), (5, "gone", 5)]), SPEC, "2024-01-01"
    )
    out = merge_changes(
        old, extract(spark, [(1, "same", 1), (2, "after", 1), (3, "x", 3), (4, "x", None), (6, "new", 6)]), SPEC, "2024-02-01"
    )
    assert out.columns == old.columns
    assert versions(out) == [
        (1, 1, "same", 1, "2024-01-01", "9999-12-31", 1),
        (2, 2, "before", 1, "2024-01-01", "2024-02-01", 0),
        (2, 6, "after", 1, "2024-02-01", "9999-12-31", 1),
        (3, 3, "x", None, "2024-01-01", "2024-02-01", 0),
        (3, 7, "x", 3, "2024-02-01", "9999-12-31", 1),
        (4, 4, "x", 4, "2024-01-01", "2024-02-01", 0),
        (4, 8, "x", None, "2024-02-01", "9999-12-31", 1),
        (5, 5, "gone", 5, "2024-01-01", "9999-12-31", 1),
        (6, 9, "new", 6, "2024-02-01", "9999-12-31", 1),
    ]


def test_same_extract_again_changes_nothing(spark):
    rows = [(1, "a", None), (2, None, 2)]
    old = first_load(extract(spark, rows), SPEC, "2024-01-01")
    assert versions(merge_changes(old, extract(spark, rows), SPEC, "2024-02-01")) == versions(old)


def test_second_change_on_a_load_date_replaces_the_first(spark):
    old = first_load(extract(spark, [(1, "a", 1)]), SPEC, "2024-01-01")
    once = merge_changes(old, extract(spark, [(1, "b", 1), (2, "n", 2)]), SPEC, "2024-02-01")
    twice = merge_changes(once, extract(spark, [(1, "c", 1), (2, "m", 2)]), SPEC, "2024-02-01")
    assert versions(twice) == [
        (1, 1, "a", 1, "2024-01-01", "2024-02-01", 0),
        (1, 2, "c", 1, "2024-02-01", "9999-12-31", 1),
        (2, 3, "m", 2, "2024-02-01", "9999-12-31", 1),
    ]


def test_merge_without_load_date_uses_today(spark):
    old = first_load(extract(spark, [(1, "a", 1)]), SPEC, "2024-01-01")
    out = merge_changes(old, extract(spark, [(1, "b", 1)]), SPEC)
    ended, opened = sorted(out.collect(), key=lambda r: r.SK_Cliente)
    assert ended.data_fim == opened.data_inicio >= date(2024, 1, 2)


def test_differing_columns_are_refused(spark):
    old = first_load(extract(spark, [(1, "a", 1)]), SPEC, "2024-01-01")
    with pytest.raises(ValueError, match="CidadeID"):
        merge_changes(old, old.select("ClienteID", "Nome"), SPEC, "2024-02-01")


@pytest.mark.parametrize("seed", range(2))
def test_history_of_random_loads(spark, seed):
    """Several loads against a row-by-row model, and the invariants of a history."""
    rng = random.Random(seed)
    state: dict[int, tuple] = {}
    dimension, model = None, {}
    for n in range(4):
        for key in rng.sample(range(1, 9), 4):
            state[key] = (rng.choice(["a", "b", None]), rng.choice([1, 2, None]))
        gone = rng.choice(list(state))
        sent = {k: v for k, v in state.items() if n == 0 or k != gone}
        on = f"2024-0{n + 1}-01"
        for key, value in sent.items():
            chain = model.setdefault(key, [])
            if not chain or chain[-1][0] != value:
                chain.append((value, on))
        rows = extract(spark, [(k, *v) for k, v in sent.items()])
        dimension = first_load(rows, SPEC, on) if dimension is None else merge_changes(dimension, rows, SPEC, on)

    rows = dimension.collect()
    assert sorted(r.SK_Cliente for r in rows) == list(range(1, len(rows) + 1))
    for key, chain in model.items():
        mine = sorted((r for r in rows if r.ClienteID == key), key=lambda r: r.data_inicio)
        assert [((r.Nome, r.CidadeID), str(r.data_inicio)) for r in mine] == chain
        assert [r.registro_ativo for r in mine] == [0] * (len(mine) - 1) + [1]
        assert [r.data_fim for r in mine] == [r.data_inicio for r in mine[1:]] + [OPEN]
    assert len(rows) == sum(len(c) for c in model.values())


@pytest.mark.parametrize(("rows", "what"), [([(None, "a", 1), (1, "b", 1)], "null keys"), ([(1, "a", 1), (1, "b", 1)], "repeated")])
def test_extracts_without_unique_keys_are_refused(spark, rows, what):
    old = first_load(extract(spark, [(1, "a", 1)]), SPEC, "2024-01-01")
    with pytest.raises(ValueError, match=what):
        merge_changes(old, extract(spark, rows), SPEC, "2024-02-01")


def test_loads_before_the_newest_version_are_refused(spark):
    old = first_load(extract(spark, [(1, "new", 1)]), SPEC, "2024-02-01")
    with pytest.raises(ValueError, match="before 2024-02-01"):
        merge_changes(old, extract(spark, [(1, "older", 1)]), SPEC, "2024-01-01")
