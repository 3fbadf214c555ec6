from pyspark.sql import functions as F

from stratamart.operators.keys import extend_keys, highest, number_rows


def keyed(df, key="k", sk="sk"):
    return {r[key]: r[sk] for r in df.collect()}


def test_keys_are_dense_and_in_key_order_however_the_table_is_split(spark):
    keys = [(i * 37) % 1009 for i in range(1009)]
    expected = {k: i + 1 for i, k in enumerate(sorted(keys))}
    for parts in (1, 3, 16):
        df = spark.createDataFrame([(k, f"v{k}") for k in keys], "k bigint, v string").repartition(parts)
        out = number_rows(df, "k", "sk")
        assert out.columns == ["k", "v", "sk"]
        assert keyed(out) == expected
        assert keyed(out) == expected  # a second execution numbers the same


def test_many_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = number_rows(spark.range(5000, 0, -1), "id", "sk")
        assert {(r.id, r.sk) for r in out.collect()} == {(i, i) for i in range(1, 5001)}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_string_keys_and_start(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    assert keyed(number_rows(df, "k", "sk", after=10)) == {"a": 11, "b": 12, "c": 13}


def test_empty_table(spark):
    df = spark.createDataFrame([], "k bigint")
    assert number_rows(df, "k", "sk").count() == 0
    assert highest(number_rows(df, "k", "sk"), "sk") == 0


def test_known_keys_stay_and_new_ones_follow(spark):
    known = spark.createDataFrame([(5, 1), (9, 2)], "k bigint, sk bigint")
    df = spark.createDataFrame([(1,), (5,), (7,)], "k bigint")
    assert keyed(extend_keys(known, df, "k", "sk")) == {5: 1, 1: 3, 7: 4}


def test_rows_sharing_a_key_are_spread_and_numbered_once(spark):
    """A third of the rows have no key: no slice gets them all, and the numbering stays dense."""
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, null, id) as k", "concat('v', id) as v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = number_rows(rows, "k", "sk").cache()
        ranks = sorted(r.sk for r in out.collect())
        hot = out.filter("k is null").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranks == list(range(1, 3001))
    assert len(hot) > 1
    assert sorted(r.sk for r in out.filter("k is null").collect()) == list(range(1, 1001))
