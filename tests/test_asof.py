"""Prices by time of day."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from stratamart.operators.asof import price_as_of_time

START = datetime(2020, 1, 1)


def frames(spark, sold, priced):
    sales = spark.createDataFrame(sold, "VendasID bigint, ProdutoID bigint, quando timestamp_ntz, _row string")
    prices = spark.createDataFrame(
        [(p, Decimal(v), at) for p, v, at in priced], "ProdutoID bigint, Preco decimal(12,2), DataCadastro timestamp_ntz"
    )
    return sales.repartition(3), prices


def plain(sold, priced):
    out = Counter()
    for sale, product, at, _ in sold:
        known = [(t, Decimal(v)) for p, v, t in priced if None not in (t, at, product) and p == product and t <= at]
        out[sale, max(known)[1] if known else None] += 1
    return out


def run(spark, sold, priced, **options):
    sales, prices = frames(spark, sold, priced)
    found = price_as_of_time(sales, prices, "quando", **options)
    assert found.columns == [*sales.columns, "PrecoUnitario"]
    return Counter((r.VendasID, r.PrecoUnitario) for r in found.collect())


@pytest.mark.parametrize("hours", [24, 6, 1])
def test_against_plain_python_with_a_hot_product(spark, hours):
    rng = random.Random(hours)
    def moment():
        return START + timedelta(seconds=rng.randrange(6 * 86400) // 600 * 600)
    # Product 1 has a third of all sales and most prices; times fall together often.
    sold = [(i, 1 if i % 3 == 0 else rng.randrange(2, 9), moment(), "clash") for i in range(900)]
    priced = [(1 if i % 2 else rng.randrange(2, 8), f"{rng.randrange(1, 500)}.50", moment()) for i in range(200)]
    assert run(spark, sold, priced, hours=hours) == plain(sold, priced)


def test_nulls_ties_repeats_and_empty_tables(spark):
    noon = START + timedelta(hours=12)
    sold = [(1, 1, noon, None), (1, 1, noon, None), (2, None, noon, None), (3, 1, None, None), (4, 1, START, None), (5, 9, noon, None)]
    priced = [(1, "5.00", noon), (1, "7.00", noon), (1, "9.00", noon + timedelta(seconds=1)), (1, "1.00", None), (None, "2.00", noon)]
    assert run(spark, sold, priced) == plain(sold, priced)
    assert run(spark, sold, []) == plain(sold, [])
    assert run(spark, [], priced) == Counter()
    with pytest.raises(ValueError, match="divide"):
        run(spark, sold, priced, hours=5)


def test_a_price_from_long_before_is_handed_over(spark):
    sold = [(1, 1, START + timedelta(days=4000), None), (2, 1, START + timedelta(days=2), None)]
    priced = [(1, "3.00", START), (1, "4.00", START + timedelta(days=3))]
    assert run(spark, sold, priced) == plain(sold, priced)


def test_sales_are_shuffled_once_and_never_paired(spark, capsys):
    sales, prices = frames(spark, [(1, 1, START, None)], [(1, "3.00", START)])
    price_as_of_time(sales, prices, "quando").explain("formatted")
    plan = capsys.readouterr().out
    assert "Join" not in plan
