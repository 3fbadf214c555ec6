from stratamart.operators.shaping import merge_names, move_after, stack


def people(spark, rows):
    return spark.createDataFrame(
        rows, "Nivel int, ClienteID bigint, PrimeiroNome string, NomeDoMeio string, UltimoNome string, Cidade string"
    )


def test_names_are_merged_and_placed_behind_the_key(spark):
    df = merge_names(
        people(
            spark,
            [
                (9, 1, "a", None, "c", "x"),
                (9, 2, None, None, None, "x"),
                (9, 3, "a", "", "c", "x"),
                (9, 4, "a", "b", "c", "x"),
            ],
        ),
        "ClienteID",
    )
    assert df.columns == ["Nivel", "ClienteID", "Nome", "Cidade"]
    assert {r.ClienteID: r.Nome for r in df.collect()} == {1: "a c", 2: "", 3: "a  c", 4: "a b c"}


def test_key_first(spark):
    df = spark.createDataFrame([(1, "x", "y")], "k int, a string, b string")
    assert move_after(df, "b", "k").columns == ["k", "b", "a"]
    assert move_after(df, "k", "b").columns == ["a", "b", "k"]


def test_stack_matches_by_name_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "v string, k int")
    assert sorted(tuple(r) for r in stack(a, b).collect()) == [(1, "x"), (1, "x"), (2, "y")]
