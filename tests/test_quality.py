from stratamart.operators.audit import load_audit
from stratamart.operators.quality import duplicate_keys, null_values, orphans, quality_report
from tests.frames import day, sales
from pyspark.sql import functions as F


def found(df):
    return {r.regra: r.linhas for r in df.collect()}


def test_rules(spark):
    rows = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (2, "c"), (2, "c"), (2, "c")], "k int, v string")
    assert found(null_values(rows, "t", ["k", "v"])) == {"nulo:k": 1, "nulo:v": 1}
    assert found(duplicate_keys(rows, "t", "k")) == {"duplicado:k": 2}
    parent = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert found(orphans(rows, "t", "k", parent)) == {"orfao:k": 3}
    assert found(orphans(rows, "t", "k", rows.select("k"))) == {"orfao:k": 0}


def test_report_is_one_row_per_rule(spark):
    fact = sales(spark, [(1, 1, "2018-01-01"), (1, 2, None)]).withColumns(
        {"PrecoUnitario": F.lit(None).cast("decimal(12,2)"), "PrecoTotal": F.lit(1).cast("decimal(18,2)")}
    )
    parents = {
        "ProdutoID": ("produtos", spark.createDataFrame([(1,), (1,)], "ProdutoID bigint")),
        "PaisID": ("paises", spark.createDataFrame([(None,), (1,)], "PaisID int")),
    }
    report = quality_report(fact, "vendas", parents)
    assert report.columns == ["tabela", "regra", "linhas"]
    assert {(r.tabela, r.regra): r.linhas for r in report.collect()} == {
        ("vendas", "nulo:PrecoUnitario"): 2,
        ("vendas", "nulo:PrecoTotal"): 0,
        ("vendas", "nulo:DataVenda"): 1,
        ("vendas", "duplicado:VendasID"): 1,
        ("vendas", "orfao:ProdutoID"): 1,
        ("produtos", "nulo:ProdutoID"): 0,
        ("produtos", "duplicado:ProdutoID"): 1,
        ("paises", "nulo:PaisID"): 1,
        ("paises", "duplicado:PaisID"): 0,
    }


def test_audit_without_mark_keeps_all(spark):
    batch = sales(spark, [(1, 1, "2018-01-01"), (2, 1, None)]).withColumn("lote", F.lit("b"))
    row = load_audit(batch, None).first()
    assert (row.lidas, row.mantidas, row.descartadas, row.sem_data, row.marca) == (2, 2, 0, 1, None)
    row = load_audit(batch, day("2017-01-01")).first()
    assert (row.mantidas, row.descartadas) == (1, 1)
