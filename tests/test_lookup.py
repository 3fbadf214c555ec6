import pytest

from stratamart.model import DIMENSIONS, Dimension
from stratamart.operators.broadcasting import SETTING, fits_broadcast
from stratamart.operators.dimensions import first_load, merge_changes
from stratamart.operators.lookup import current_versions, swap_keys, swap_keys_at_date
from tests.frames import sales

SPEC = DIMENSIONS["produtos"]


@pytest.fixture(scope="module")
def history(spark):
    """Product 1 changes in March and in May, product 2 never."""
    rows = [spark.createDataFrame([(1, n), (2, "x")], "ProdutoID bigint, Nome string") for n in ("a", "b", "c")]
    first = first_load(rows[0], SPEC, "2018-01-01")
    second = merge_changes(first, rows[1], SPEC, "2018-03-01")
    return merge_changes(second, rows[2], SPEC, "2018-05-01")


def swapped(df):
    return {r.VendasID: r.SK_Produto for r in df.collect()}


def test_keys_are_swapped_and_rows_kept(spark, history):
    fact = sales(spark, [(1, 1, "2018-01-01"), (2, 2, "2018-01-01"), (3, 77, "2018-01-01"), (4, None, "2018-01-01")])
    out = swap_keys(fact, [(SPEC, current_versions(history))])
    assert "ProdutoID" not in out.columns and out.columns[-1] == "SK_Produto"
    assert swapped(out) == {1: 4, 2: 2, 3: None, 4: None}


def test_chained_dimensions(spark):
    fact = sales(spark, [(1, 1, "2018-01-01")])
    city = Dimension("vendedores", "VendedorID", "SK_Vendedor")
    keys = [
        (SPEC, spark.createDataFrame([(1, 10)], "ProdutoID bigint, SK_Produto bigint")),
        (city, spark.createDataFrame([(1, 20)], "VendedorID bigint, SK_Vendedor bigint")),
    ]
    row = swap_keys(fact, keys).first()
    assert (row.SK_Produto, row.SK_Vendedor) == (10, 20)
    assert not {"ProdutoID", "VendedorID"} & set(row.asDict())


@pytest.mark.parametrize("limit", [256 * 1024 * 1024, 0])
def test_version_valid_on_the_sale_date(spark, history, limit):
    fact = sales(
        spark,
        [
            (1, 1, "2010-06-01"),
            (2, 1, "2018-02-28"),
            (3, 1, "2018-03-01"),
            (4, 1, "2018-04-30"),
            (5, 1, "2018-05-01"),
            (6, 1, "2030-01-01"),
            (7, 2, "2018-04-01"),
            (8, 1, None),
            (9, 77, "2018-04-01"),
            (10, 2, None),
            (11, 2, "9999-12-30"),
            *((k, 1, "2018-02-28") for k in range(100, 200)),
        ],
    )
    out = swap_keys_at_date(fact, [(SPEC, history)], limit=limit)
    assert swapped(out) == {1: 1, 2: 1, 3: 3, 4: 3, 5: 4, 6: 4, 7: 2, 8: None, 9: None, 10: 2, 11: 2} | dict.fromkeys(range(100, 200), 1)


def test_broadcast_bound(spark, tmp_path):
    keys = spark.range(100).selectExpr("id as k", "id as sk", "'text' as t")
    fixed = keys.select("k", "sk")
    assert fits_broadcast(fixed)
    assert fits_broadcast(fixed, limit=100 * 56) and not fits_broadcast(fixed, limit=100 * 56 - 1)
    assert not fits_broadcast(keys)  # text has no fixed width
    spark.conf.set(SETTING, "1000")
    try:
        assert not fits_broadcast(fixed)
    finally:
        spark.conf.unset(SETTING)
