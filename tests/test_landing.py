from decimal import Decimal

import pytest
from pyspark.sql import types as T

from stratamart.model import DECLARED, PRODUCTS, SALES
from stratamart.sources.landing import LandingFileError, scan_csv
from tests.frames import day, write_text

HEADER = "VendasID,VendedorID,ClienteID,ProdutoID,Quantidade,Desconto,DataVenda,NumeroTransacao\n"


def test_declared_types_are_used(spark, tmp_path):
    path = write_text(tmp_path / "v.csv", HEADER + "1,2,3,4,5.5,0.10,2018-01-05,t1\n2,2,3,4,,,,\n")
    df = scan_csv(spark, path, DECLARED[SALES])
    assert df.schema == DECLARED[SALES]
    assert [tuple(r) for r in df.orderBy("VendasID").collect()] == [
        (1, 2, 3, 4, Decimal("5.50"), Decimal("0.10"), day("2018-01-05"), "t1"),
        (2, 2, 3, 4, None, None, None, None),
    ]


def test_columns_are_matched_by_name(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", "DataCadastro,ProdutoID,Preco\n2018-02-01,7,9.90\n")
    row = scan_csv(spark, path, DECLARED[PRODUCTS]).first()
    assert (row.ProdutoID, row.Preco, row.DataCadastro) == (7, Decimal("9.90"), day("2018-02-01"))


def test_undeclared_columns_pass_through(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", "ProdutoID,Produto,Preco,DataCadastro,Peso\n7,bolt,9.90,2018-02-01,12\n")
    typed = scan_csv(spark, path, DECLARED[PRODUCTS])
    assert typed.columns == ["ProdutoID", "Produto", "Preco", "DataCadastro", "Peso"]
    assert (typed.schema["Produto"].dataType, typed.schema["Peso"].dataType) == (T.StringType(), T.IntegerType())
    assert typed.schema["Preco"].dataType == T.DecimalType(12, 2)
    as_text = scan_csv(spark, path, DECLARED[PRODUCTS], infer_rest=False)
    assert as_text.first().Peso == "12"


def test_missing_declared_column_is_refused(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", "ProdutoID,Preco\n7,9.90\n")
    with pytest.raises(LandingFileError, match="DataCadastro"):
        scan_csv(spark, path, DECLARED[PRODUCTS])


def test_folder_with_disagreeing_headers_is_refused(spark, tmp_path):
    write_text(tmp_path / "p" / "a.csv", "ProdutoID,Preco,DataCadastro\n7,9.90,2018-02-01\n")
    write_text(tmp_path / "p" / "b.csv", "Preco,ProdutoID,DataCadastro\n9.90,7,2018-02-01\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, str(tmp_path / "p"), DECLARED[PRODUCTS]).collect()


def test_short_rows_are_padded_and_long_ones_cut(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", "ProdutoID,Preco,DataCadastro\n7\n8,1.00,2018-02-01,extra\n")
    rows = {tuple(r) for r in scan_csv(spark, path, DECLARED[PRODUCTS]).collect()}
    assert rows == {(7, None, None), (8, Decimal("1.00"), day("2018-02-01"))}


def test_malformed_value_is_null_or_an_error(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", "ProdutoID,Preco,DataCadastro\n7,cheap,2018-02-01\n8,1.00,05/02/2018\n")
    rows = {tuple(r) for r in scan_csv(spark, path, DECLARED[PRODUCTS]).collect()}
    assert rows == {(7, None, day("2018-02-01")), (8, Decimal("1.00"), None)}
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_csv(spark, path, DECLARED[PRODUCTS], mode="FAILFAST").collect()


def test_inferred_types(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", "a;b;c\n1;x;2018-02-01\n")
    df = scan_csv(spark, path, delimiter=";")
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "string", "date"]


def test_header_only_file_is_empty(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", "ProdutoID,Preco,DataCadastro\n")
    df = scan_csv(spark, path, DECLARED[PRODUCTS])
    assert df.count() == 0 and df.schema == DECLARED[PRODUCTS]
