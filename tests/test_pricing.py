import random
from collections import Counter, defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratamart.operators.pricing import conform_sales, price_as_of, price_by_product, with_totals
from stratamart.operators.validity import intervals
from tests.frames import products, sales


def prices(df):
    return {r.VendasID: r.PrecoUnitario for r in df.collect()}


def test_price_needs_registration_on_or_before_the_sale(spark):
    sold = sales(spark, [(1, 1, "2018-01-31"), (2, 1, "2018-02-01"), (3, 1, "2018-02-02"), (4, 99, "2018-02-02"), (5, 1, None)])
    known = products(spark, [(1, "10.00", "2018-02-01")])
    expected = {1: None, 2: Decimal("10.00"), 3: Decimal("10.00"), 4: None, 5: None}
    assert prices(price_by_product(sold, known)) == expected
    assert prices(price_by_product(sold, known, limit=0)) == expected
    assert prices(price_as_of(sold, known)) == expected


def test_several_prices_fan_out_in_the_lookup_but_not_as_of(spark):
    sold = sales(spark, [(1, 1, "2018-06-01"), (2, 1, "2018-02-15")])
    history = products(spark, [(1, "10", "2018-01-01"), (1, "11", "2018-02-01"), (1, "12", "2018-03-01")])
    assert price_by_product(sold, history).count() == 5
    assert prices(price_as_of(sold, history)) == {1: Decimal("12.00"), 2: Decimal("11.00")}


def test_of_two_prices_on_a_day_the_higher_counts(spark):
    sold = sales(spark, [(1, 1, "2018-06-01")])
    assert prices(price_as_of(sold, products(spark, [(1, "12", "2018-01-01"), (1, "10", "2018-01-01")]))) == {1: 12}


def test_totals_round_half_up_in_decimals(spark):
    sold = sales(spark, [(1, 1, "2018-01-01", "1", "0.50"), (2, 1, "2018-01-01", "3", "0.10"), (3, 2, "2018-01-01", "1", "0")])
    known = products(spark, [(1, "10.01", "2018-01-01"), (2, None, "2018-01-01")])
    totals = {r.VendasID: r.PrecoTotal for r in with_totals(price_by_product(sold, known)).collect()}
    assert totals == {1: Decimal("5.01"), 2: Decimal("27.03"), 3: None}


def test_total_is_missing_exactly_when_no_product_was_registered(spark):
    out = conform_sales(
        sales(spark, [(1, 1, "2018-01-31"), (2, 1, "2018-02-01"), (3, 2, "2018-02-01")]),
        products(spark, [(1, "10.00", "2018-02-01")]),
    )
    assert out.columns == [
        "VendasID", "VendedorID", "ClienteID", "ProdutoID", "Quantidade", "PrecoUnitario",
        "Desconto", "PrecoTotal", "DataVenda", "Ano", "Mes",
    ]
    assert {(r.VendasID, r.PrecoTotal is None, r.Ano, r.Mes) for r in out.collect()} == {
        (1, True, 2018, 1), (2, False, 2018, 2), (3, True, 2018, 2),
    }


def test_registration_later_on_the_sale_day_does_not_count(spark):
    known = spark.sql("select 1L as ProdutoID, 2 as Preco, timestamp'2018-01-01 08:00:00' as DataCadastro")
    assert prices(price_by_product(sales(spark, [(1, 1, "2018-01-01"), (2, 1, "2018-01-02")]), known)) == {1: None, 2: 2}


def test_price_of_a_double_is_rounded_half_up(spark):
    known = spark.sql("select 1L as ProdutoID, 1.005D as Preco, date'2018-01-01' as DataCadastro")
    assert prices(price_by_product(sales(spark, [(1, 1, "2018-01-01")]), known)) == {1: Decimal("1.01")}


def test_validity_needs_dates(spark):
    with pytest.raises(TypeError):
        intervals(spark.sql("select 1 as k, timestamp'2018-01-01 00:00:00' as since, 1 as v"), "k", "since", "v")


@pytest.mark.parametrize("limit", [256 * 1024 * 1024, 0])
@pytest.mark.parametrize("seed", range(3))
def test_as_of_agrees_with_brute_force(spark, limit, seed):
    """Product 1 has a third of the sales and of the prices; both join paths give all rows."""
    rng = random.Random(seed)
    start = date(2015, 11, 1)

    def any_product():
        return 1 if rng.random() < 1 / 3 else rng.randrange(2, 8)

    def any_day():
        return start + timedelta(days=rng.randrange(1500))

    history = [(any_product(), f"{rng.randrange(100, 900)}.25", any_day().isoformat()) for _ in range(60)]
    sold = [(i, any_product(), any_day().isoformat() if rng.random() > 0.05 else None) for i in range(300)]
    by_product = defaultdict(list)
    for product, price, since in history:
        by_product[product].append((since, Decimal(price)))
    expected = Counter(
        (i, max(((s, p) for s, p in by_product[k] if on and s <= on), default=(None, None))[1]) for i, k, on in sold
    )
    out = price_as_of(sales(spark, sold), products(spark, history), limit=limit)
    assert Counter((r.VendasID, r.PrecoUnitario) for r in out.collect()) == expected


def test_hot_product_is_split_in_the_shuffled_join(spark):
    """With a third of all sales on one product the adaptive planner splits that partition."""
    sold = spark.range(300_000, numPartitions=8).select(
        F.col("id").alias("VendasID"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).alias("ProdutoID"),
        F.lit("2018-05-01").cast("date").alias("DataVenda"),
        F.sha2(F.col("id").cast("string"), 256).alias("rest"),
    )
    known = spark.range(500).select(
        F.col("id").alias("ProdutoID"), F.lit(2).alias("Preco"), F.lit("2018-01-01").cast("date").alias("DataCadastro")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        out = price_by_product(sold, known, limit=0)
        assert out.filter("PrecoUnitario = 2").count() == 300_000
        counted = out.groupBy().agg(F.count("rest"), F.count("PrecoUnitario"))
        counted.collect()
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for name in settings:
            spark.conf.unset(name)
