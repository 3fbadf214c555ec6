"""Loads from the landing zone through to gold, and again with new batches."""

import shutil
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratamart.model import DIMENSIONS, Lake
from stratamart.operators.months import differing_months, in_months
from stratamart.operators.pricing import with_calendar
from stratamart.operators.watermark import high_watermark, newer_than, read_watermark
from stratamart.plans import bronze, gold, incremental, silver
from stratamart.plans.report import silver_quality
from stratamart.sinks.tables import SchemaMismatch, overwrite, overwrite_partitioned
from stratamart.sources.tables import scan_table
from tests.frames import day, plan_of, sales, write_text

LANDING = {
    "categorias.csv": "CategoriaID,Categoria\n1,tools\n2,toys\n",
    "produtos.csv": "ProdutoID,Produto,CategoriaID,Preco,DataCadastro\n101,saw,1,10.00,2018-02-01\n102,top,2,2.50,2017-01-01\n",
    "clientes.csv": "ClienteID,PrimeiroNome,NomeDoMeio,UltimoNome,CidadeID\n1,Ana,,Lima,1\n2,Rui,M,Reis,2\n",
    "cidades.csv": "CidadeID,Cidade,PaisID\n1,Recife,1\n2,Porto,2\n",
    "paises.csv": "PaisID,Pais\n1,Brasil\n2,Portugal\n",
    "vendedores.csv": "VendedorID,PrimeiroNome,NomeDoMeio,UltimoNome\n5,Eva,,Melo\n",
    "vendas_1.csv": "VendasID,VendedorID,ClienteID,ProdutoID,Quantidade,Desconto,DataVenda,NumeroTransacao\n"
    "1,5,1,101,2,0.10,2018-01-15,t1\n2,5,2,101,2,0.10,2018-02-15,t2\n3,5,1,102,3,0,2018-03-01,t3\n4,5,9,102,1,0,,t4\n",
    "vendas_2.csv": "VendasID,VendedorID,ClienteID,ProdutoID,Quantidade,Desconto,DataVenda,NumeroTransacao\n"
    "5,5,1,101,1,0,2018-02-28,t5\n6,5,1,101,1,0,2018-03-01,t6\n7,5,2,101,1,0,2018-03-02,t7\n8,5,2,101,1,0,,t8\n",
    "vendas_3.csv": "NumeroTransacao,VendasID,VendedorID,ClienteID,ProdutoID,Quantidade,Desconto,DataVenda\n"
    "t9,9,5,2,102,4,0.50,2018-04-01\n",
}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    for name, text in LANDING.items():
        write_text(root / "landingzone" / name, text)
    lake = Lake.under(str(root))
    bronze.ingest(spark, lake)
    silver.build(spark, lake)
    gold.build(spark, lake, "2020-01-01")
    return root


@pytest.fixture
def lake(built, tmp_path):
    """A copy of the fully loaded lake for each test to change."""
    shutil.copytree(built, tmp_path / "lake")
    return Lake.under(str(tmp_path / "lake"))


def table(spark, lake, layer, name):
    return scan_table(spark, lake.table(layer, name), lake.fmt)


def by_id(df, column, key="VendasID"):
    return {r[key]: r[column] for r in df.collect()}


def test_full_load(spark, lake):
    assert table(spark, lake, "bronze", "vendas").count() == 4
    people = table(spark, lake, "silver", "clientes")
    assert people.columns == ["ClienteID", "Nome", "CidadeID"]
    assert by_id(people, "Nome", "ClienteID") == {1: "Ana Lima", 2: "Rui M Reis"}
    sold = table(spark, lake, "silver", "vendas")
    assert by_id(sold, "PrecoTotal") == {1: None, 2: Decimal("18.00"), 3: Decimal("7.50"), 4: None}
    assert by_id(sold, "Mes") == {1: 1, 2: 2, 3: 3, 4: None}
    assert by_id(table(spark, lake, "gold", "cidades"), "SK_Cidade", "CidadeID") == {1: 1, 2: 2}
    fact = table(spark, lake, "gold", "vendas")
    assert set(fact.columns) == {
        "VendasID", "Quantidade", "PrecoUnitario", "Desconto", "PrecoTotal", "DataVenda",
        "Ano", "Mes", "SK_Cliente", "SK_Vendedor", "SK_Produto",
    }
    assert by_id(fact, "SK_Cliente") == {1: 1, 2: 2, 3: 1, 4: None}
    for spec in DIMENSIONS.values():
        dim = table(spark, lake, "gold", spec.table)
        assert {r.data_inicio for r in dim.collect()} == {date(2020, 1, 1)}


def test_inferred_types_load_the_same_totals(spark, lake, tmp_path):
    other = Lake(lake.landing, str(tmp_path / "b"), str(tmp_path / "s"), lake.gold)
    bronze.ingest(spark, other, infer=True)
    silver.build(spark, other)
    assert table(spark, other, "bronze", "vendas").schema["DataVenda"].dataType.simpleString() == "date"
    totals = by_id(table(spark, other, "silver", "vendas"), "PrecoTotal")
    assert totals == by_id(table(spark, lake, "silver", "vendas"), "PrecoTotal")


def test_swapping_keys_back_yields_the_natural_keys(spark, lake):
    fact, sold = table(spark, lake, "gold", "vendas"), table(spark, lake, "silver", "vendas")
    back = fact.join(table(spark, lake, "gold", "produtos"), "SK_Produto")
    assert by_id(back, "ProdutoID") == by_id(sold, "ProdutoID")


def test_incremental_load_appends_only_newer_rows_and_audits(spark, lake):
    audit = {r.lote: r.asDict() for r in incremental.load_sales(spark, lake, ["vendas_2", "vendas_3"]).collect()}
    sold = table(spark, lake, "silver", "vendas")
    assert by_id(sold, "PrecoTotal") == {
        1: None, 2: Decimal("18.00"), 3: Decimal("7.50"), 4: None, 7: Decimal("10.00"), 9: Decimal("5.00"),
    }
    assert by_id(sold, "ProdutoID")[9] == 102
    assert audit["vendas_2"] == {
        "lote": "vendas_2", "lidas": 4, "mantidas": 1, "descartadas": 3, "sem_data": 1,
        "primeira_data": day("2018-02-28"), "ultima_data": day("2018-03-02"), "marca": day("2018-03-01"), "ilegiveis": 0,
    }
    assert audit["vendas_3"]["mantidas"] == 1


def test_incremental_load_twice_adds_nothing(spark, lake):
    incremental.load_sales(spark, lake, ["vendas_2", "vendas_3"])
    before = sorted(map(str, table(spark, lake, "silver", "vendas").collect()))
    audit = incremental.load_sales(spark, lake, ["vendas_2", "vendas_3"])
    assert sorted(map(str, table(spark, lake, "silver", "vendas").collect())) == before
    assert {r.mantidas for r in audit.collect()} == {0}


def test_without_silver_everything_is_loaded(spark, lake, tmp_path):
    fresh = Lake(lake.landing, lake.bronze, str(tmp_path / "other"), lake.gold)
    audit = incremental.load_sales(spark, fresh, ["vendas_2", "vendas_3"])
    assert table(spark, fresh, "silver", "vendas").count() == 5
    assert sum(r.mantidas for r in audit.collect()) == 5


def test_batch_that_does_not_fit_is_refused(spark, lake):
    held = table(spark, lake, "silver", "vendas").withColumn("Quantidade", F.col("Quantidade").cast("int"))
    other = Lake(lake.landing, lake.bronze, lake.silver + "_other", lake.gold)
    overwrite_partitioned(held, other.table("silver", "vendas"), ("Ano", "Mes"))
    with pytest.raises(SchemaMismatch, match="Quantidade"):
        incremental.load_sales(spark, other, ["vendas_2"])
    assert table(spark, other, "silver", "vendas").count() == 4


def test_quality_of_silver(spark, lake):
    found = {(r.tabela, r.regra): r.linhas for r in silver_quality(spark, lake).collect() if r.linhas}
    assert found == {
        ("vendas", "nulo:PrecoUnitario"): 2,
        ("vendas", "nulo:PrecoTotal"): 2,
        ("vendas", "nulo:DataVenda"): 1,
        ("vendas", "orfao:ClienteID"): 1,
    }


def test_refresh_rewrites_changed_months_only(spark, lake):
    fact = Path(lake.table("gold", "vendas"))
    files = {p: p.stat().st_mtime_ns for p in fact.rglob("*.parquet")}
    incremental.load_sales_and_refresh(spark, lake, ["vendas_2", "vendas_3"])
    gold_ids = by_id(table(spark, lake, "gold", "vendas"), "SK_Cliente")
    assert gold_ids == {1: 1, 2: 2, 3: 1, 4: None, 7: 2, 9: 2}
    now = {p: p.stat().st_mtime_ns for p in fact.rglob("*.parquet")}
    untouched = {p for p in files if now.get(p) == files[p]}
    assert {p.parent.name for p in set(files) - untouched} == {"Mes=3"}


def test_refresh_catches_up_after_a_load_without_refresh(spark, lake):
    incremental.load_sales(spark, lake, ["vendas_2", "vendas_3"])
    assert table(spark, lake, "gold", "vendas").count() == 4
    incremental.load_sales_and_refresh(spark, lake, ["vendas_2", "vendas_3"])
    assert table(spark, lake, "gold", "vendas").count() == 6
    months = [table(spark, lake, layer, "vendas").groupBy("Ano", "Mes").count().collect() for layer in ("silver", "gold")]
    assert sorted(months[0], key=str) == sorted(months[1], key=str)


def test_refresh_without_fact_builds_it(spark, lake, tmp_path):
    fresh = Lake(lake.landing, lake.bronze, lake.silver, str(tmp_path / "gold2"))
    for spec in DIMENSIONS.values():
        gold.build_dimension(spark, fresh, spec, "2020-01-01")
    gold.refresh_sales(spark, fresh)
    assert table(spark, fresh, "gold", "vendas").count() == 4


def test_dimension_update_keeps_history_in_place(spark, lake):
    spec = DIMENSIONS["clientes"]
    moved = table(spark, lake, "silver", "clientes").withColumn("CidadeID", F.lit(2))
    overwrite(spark.createDataFrame(moved.collect(), moved.schema), lake.table("silver", "clientes"))
    gold.update_dimension(spark, lake, spec, "2020-06-01")
    rows = table(spark, lake, "gold", "clientes").collect()
    assert sorted((r.ClienteID, r.SK_Cliente, r.CidadeID, r.registro_ativo) for r in rows) == [
        (1, 1, 1, 0), (1, 3, 2, 1), (2, 2, 2, 1),
    ]


def test_watermark_forms_agree(spark, lake):
    held = table(spark, lake, "silver", "vendas")
    assert high_watermark(held).first()[0] == day("2018-03-01") == read_watermark(held.drop("Ano", "Mes"))
    batch = sales(spark, [(1, 1, "2018-02-28"), (2, 1, "2018-03-01"), (3, 1, "2018-03-02"), (4, 1, None)])
    assert {r.VendasID for r in newer_than(batch, day("2018-03-01")).collect()} == {3}


def test_no_mark_means_all_rows(spark):
    batch = sales(spark, [(1, 1, "2018-02-28"), (2, 1, None)])
    assert read_watermark(None) is None
    assert read_watermark(with_calendar(batch.limit(0))) is None
    assert newer_than(batch, None).count() == 2


def test_unreadable_target_is_not_taken_for_a_missing_one(spark, lake):
    target = Path(lake.table("silver", "vendas"))
    for file in target.rglob("*.parquet"):
        file.with_name("." + file.name + ".crc").write_bytes(b"")
        file.write_bytes(b"broken")
    with pytest.raises(Exception):
        incremental.append_sales(spark, lake, ["vendas"])


def test_watermark_reads_the_newest_month_and_reaches_the_scan(spark, lake, capsys):
    held = table(spark, lake, "silver", "vendas")
    plan = plan_of(high_watermark(held), capsys)
    assert "PartitionFilters: [isnotnull(Ano" in plan and "ReadSchema: struct<>" in plan
    batch = table(spark, lake, "bronze", "vendas")
    assert "GreaterThan(DataVenda,2018-03-01)" in plan_of(newer_than(batch, day("2018-03-01")), capsys)
    assert "PartitionFilters: [(" in plan_of(in_months(held, [(2018, 3), (None, None)]), capsys)


def test_undated_month_is_compared_too(spark):
    left = with_calendar(sales(spark, [(1, 1, "2018-02-28"), (2, 1, None)]))
    right = with_calendar(sales(spark, [(1, 1, "2018-02-28")]))
    assert differing_months(left, right) == ([(None, None)], [])
    assert differing_months(right, left) == ([], [(None, None)])
    changed = left.withColumn("Quantidade", F.col("Quantidade") + (F.col("VendasID") == 1).cast("int"))
    assert differing_months(left, changed.select(*left.columns)) == ([(2018, 2)], [])
    assert differing_months(left, left.select(*reversed(left.columns))) == ([], [])
    assert in_months(left, [(None, None)]).count() == 1
    assert in_months(left, []).count() == 0


def rewrite(spark, lake, change):
    """Replace the silver sales by what ``change`` makes of them."""
    held = table(spark, lake, "silver", "vendas")
    rows = spark.createDataFrame(change(held).collect(), held.schema)
    overwrite_partitioned(rows, lake.table("silver", "vendas"), ("Ano", "Mes"))


def test_refresh_sees_changed_values_at_equal_counts(spark, lake):
    rewrite(spark, lake, lambda df: df.withColumn("PrecoTotal", F.when(F.col("VendasID") == 2, 99).otherwise(F.col("PrecoTotal"))))
    gold.refresh_sales(spark, lake)
    assert by_id(table(spark, lake, "gold", "vendas"), "PrecoTotal")[2] == 99
    assert table(spark, lake, "gold", "vendas").count() == 4


def test_refresh_removes_months_silver_no_longer_has(spark, lake):
    rewrite(spark, lake, lambda df: df.where("Mes = 2"))
    gold.refresh_sales(spark, lake)
    spark.catalog.refreshByPath(lake.table("gold", "vendas"))
    assert by_id(table(spark, lake, "gold", "vendas"), "Mes") == {2: 2}
    assert not Path(lake.table("gold", "vendas"), "Ano=__HIVE_DEFAULT_PARTITION__", "Mes=__HIVE_DEFAULT_PARTITION__").exists()


def test_refresh_gives_late_customers_their_key(spark, lake):
    people = table(spark, lake, "silver", "clientes")
    more = spark.createDataFrame([*people.collect(), (9, "Late", 1)], people.schema)
    overwrite(more, lake.table("silver", "clientes"))
    gold.update_dimension(spark, lake, DIMENSIONS["clientes"], "2020-06-01")
    gold.refresh_sales(spark, lake)
    assert by_id(table(spark, lake, "gold", "vendas"), "SK_Cliente") == {1: 1, 2: 2, 3: 1, 4: 3}


def test_building_over_history_is_refused(spark, lake):
    before = table(spark, lake, "gold", "clientes").collect()
    with pytest.raises(ValueError, match="clientes"):
        gold.build(spark, lake, "2021-01-01")
    assert table(spark, lake, "gold", "clientes").collect() == before
    gold.build(spark, lake, "2021-01-01", restart=True)
    assert {str(r.data_inicio) for r in table(spark, lake, "gold", "clientes").collect()} == {"2021-01-01"}


def test_switch_that_broke_off_loses_nothing(spark, lake):
    path = Path(lake.table("gold", "clientes"))
    before = sorted(table(spark, lake, "gold", "clientes").collect())
    path.rename(path.with_name("clientes__previous"))  # it died before the new version took the place
    gold.update_dimension(spark, lake, DIMENSIONS["clientes"], "2020-06-01")
    assert sorted(table(spark, lake, "gold", "clientes").collect()) == before
    assert not path.with_name("clientes__previous").exists() and not path.with_name("clientes__following").exists()


def test_bad_lines_are_kept_and_counted_or_refused(spark, lake):
    text = LANDING["vendas_2.csv"].splitlines()[0] + "\n20,5,1,101,1,0,15/03/2018,t20\n21,5,1,101,1,0,2018-03-15,t21\n"
    write_text(Path(lake.landing_file("vendas_2")), text)
    with pytest.raises(Exception, match="(?i)malformed|15/03/2018"):
        incremental.load_sales_and_refresh(spark, lake, ["vendas_2"], mode="FAILFAST")
    audit = incremental.load_sales_and_refresh(spark, lake, ["vendas_2"]).first()
    assert (audit.lidas, audit.mantidas, audit.sem_data, audit.ilegiveis) == (2, 1, 1, 1)
    kept = table(spark, lake, "bronze", "vendas_2").where("VendasID = 20").first()
    assert kept.DataVenda is None and kept._linha_ilegivel == "20,5,1,101,1,0,15/03/2018,t20"
    assert set(by_id(table(spark, lake, "silver", "vendas"), "Mes")) == {1, 2, 3, 4, 21}


def test_several_prices_of_a_product_keep_the_sales(spark, lake):
    prices = table(spark, lake, "bronze", "produtos")
    later = prices.where("ProdutoID = 101").withColumns({"Preco": F.lit("20.00").cast("decimal(12,2)"), "DataCadastro": F.lit("2018-02-10").cast("date")})
    overwrite(spark.createDataFrame(prices.union(later).collect(), prices.schema), lake.table("bronze", "produtos"))
    silver.build_sales(spark, lake)
    found = by_id(table(spark, lake, "silver", "vendas"), "PrecoUnitario")
    assert table(spark, lake, "silver", "vendas").count() == 4
    assert found == {1: None, 2: Decimal("20.00"), 3: Decimal("2.50"), 4: None}


def test_watermark_of_another_column_looks_at_all_months(spark):
    rows = with_calendar(sales(spark, [(1, 1, "2018-02-28"), (2, 1, "2018-03-01")]))
    loaded = F.when(F.col("VendasID") == 1, F.lit("2020-09-09")).otherwise(F.lit("2019-01-01")).cast("date")
    assert high_watermark(rows.withColumn("DataCarga", loaded), "DataCarga").first()[0] == day("2020-09-09")
