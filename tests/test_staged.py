"""Loads that break off, and what the next load makes of them."""

import pytest

from stratamart.model import PRODUCTS, SALES, SALES_PARTITIONS, Lake
from stratamart.plans import incremental
from stratamart.sinks import staged
from stratamart.sinks.staged import append_staged, finish_loads, loads, stage, staging_of
from stratamart.sinks.tables import SchemaMismatch, overwrite
from stratamart.sources.tables import scan_table
from tests.frames import products, sales


class Broken(Exception):
    pass


FIRST = [(1, 101, "2018-01-10"), (2, 101, "2018-02-10")]
SECOND = [(3, 101, "2018-02-20"), (4, 101, "2018-03-01"), (5, 101, "2018-03-02"), (6, 101, "2018-01-05"), (7, 101, None)]


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    overwrite(products(spark, [(101, "10.00", "2017-01-01")]), lake.table("bronze", PRODUCTS))
    for batch, rows in (("vendas_1", FIRST), ("vendas_2", SECOND)):
        overwrite(sales(spark, rows), lake.table("bronze", batch))
    return lake


def ids(spark, lake):
    return sorted(r[0] for r in scan_table(spark, lake.table("silver", SALES)).select("VendasID").collect())


def break_at(monkeypatch, step):
    """Every call that changes files counts; the one with the given number fails, and all after it."""
    calls = [0]

    def guarded(f):
        def call(*args, **kwargs):
            calls[0] += 1
            if calls[0] > step:
                raise Broken
            return f(*args, **kwargs)

        return call

    for name in ("rename", "remove", "make_folder", "write_text"):
        monkeypatch.setattr(staged, name, guarded(getattr(staged, name)))
    return calls


def test_every_step_can_break(spark, lake, monkeypatch):
    incremental.append_sales(spark, lake, ["vendas_1"])
    start = {r.VendasID for r in scan_table(spark, lake.table("silver", SALES)).collect()}
    assert start == {1, 2}
    import shutil

    silver = lake.silver
    broke = 0
    for step in range(40):
        shutil.copytree(silver, f"{silver}-kept", dirs_exist_ok=False)
        with monkeypatch.context() as patch:
            break_at(patch, step)
            try:
                incremental.append_sales(spark, lake, ["vendas_2"])
                whole = True
            except Broken:
                whole = False
                broke += 1
        audit = incremental.append_sales(spark, lake, ["vendas_2"]).first()
        assert ids(spark, lake) == [1, 2, 3, 4, 5], step
        # What was staged as a whole counted; the batch as loaded again then has nothing newer.
        assert audit.mantidas in (0, 3)
        assert not finish_loads(spark, lake.table("silver", SALES))
        if whole:
            break
        shutil.rmtree(silver)
        shutil.move(f"{silver}-kept", silver)
    assert whole and broke > 6


def test_unfinished_writing_is_dropped_and_complete_loads_are_published(spark, lake):
    incremental.append_sales(spark, lake, ["vendas_1"])
    target = lake.table("silver", SALES)
    rows = scan_table(spark, target)
    overwrite(rows, f"{staging_of(target)}/halfway.writing")
    name = stage(rows, target, SALES_PARTITIONS, target=rows.schema, record={"lotes": ["again"]})
    assert finish_loads(spark, target) == [name]
    assert ids(spark, lake) == [1, 1, 2, 2]
    assert finish_loads(spark, target) == []
    assert {tuple(r.lotes) for r in loads(spark, target).collect()} == {("vendas_1",), ("again",)}


def test_types_are_checked_before_anything_is_staged(spark, lake):
    incremental.append_sales(spark, lake, ["vendas_1"])
    target = lake.table("silver", SALES)
    rows = scan_table(spark, target)
    with pytest.raises(SchemaMismatch):
        append_staged(rows.drop("Desconto"), target, SALES_PARTITIONS, target=rows.schema)
    assert ids(spark, lake) == [1, 2]


def test_a_third_of_all_rows_in_one_month(spark, lake):
    incremental.append_sales(spark, lake, ["vendas_1"])
    rows = [(10 + i, 101, "2018-06-15" if i % 3 == 0 else f"2018-0{3 + i % 3}-{1 + i % 28:02d}") for i in range(600)]
    overwrite(sales(spark, rows).repartition(8), lake.table("bronze", "vendas_3"))
    incremental.append_sales(spark, lake, ["vendas_3"])
    assert ids(spark, lake) == [1, 2, *range(10, 610)]


def test_undated_rows_alone_do_not_come_twice(spark, lake):
    overwrite(sales(spark, [(1, 101, None), (2, 101, None)]), lake.table("bronze", "vendas_1"))
    for _ in range(2):
        incremental.append_sales(spark, lake, ["vendas_1"])
        assert ids(spark, lake) == [1, 2]
    incremental.append_sales(spark, lake, ["vendas_2"])
    assert ids(spark, lake) == [1, 2, 3, 4, 5, 6]
    assert dict(scan_table(spark, lake.table("silver", SALES)).dtypes)["Ano"] == "int"
