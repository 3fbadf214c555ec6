"""Files that infer differently."""

import pytest
from pyspark.sql import types as T

from stratamart.model import SALES, Lake
from stratamart.plans import bronze
from stratamart.sinks.tables import append_partitioned, fit
from stratamart.sources.merged import scan_merged, widened
from stratamart.sources.tables import scan_table
from tests.frames import write_text

FILES = {
    "a": "id,v,d,s,only\n1,1,2020-01-01,7,x\n2,,2020-01-02,8,\n",
    "b": "d,id,v,s\n2020-01-03 10:30:00,3,2.5,9\n,5000000000,-1e3,12345678901234567890\n",
    "c": "id,v,d,s,empty\n4,9,2020-02-30,true,\n",
}


def land(root):
    return {name: write_text(root / f"{name}.csv", text) for name, text in FILES.items()}


@pytest.mark.parametrize("order", ["abc", "cab", "bca"])
def test_one_schema_whatever_the_order(spark, tmp_path, order):
    paths = land(tmp_path)
    tables, schema = scan_merged(spark, [paths[name] for name in order])
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    # 2020-02-30 is no day, so that column is text.
    assert kinds == {"id": "bigint", "v": "double", "d": "string", "s": "string", "only": "string", "empty": "string"}
    rows = {r.id: (r.v, r.d, r.s) for t in tables for r in t.collect()}
    assert rows[3] == (2.5, "2020-01-03 10:30:00", "9") and rows[5000000000] == (-1000.0, None, "12345678901234567890")
    assert rows[1] == (1.0, "2020-01-01", "7") and rows[2][0] is None and rows[4][2] == "true"


def test_days_and_moments_and_wide_numbers(spark, tmp_path):
    paths = land(tmp_path)
    tables, schema = scan_merged(spark, [paths["a"], paths["b"]])
    assert schema["d"].dataType == T.TimestampNTZType() and schema["s"].dataType == T.DecimalType(38, 0)
    assert str(tables[0].orderBy("id").first().d) == "2020-01-01 00:00:00"
    # What the files share can be appended to one table.
    for t in tables:
        append_partitioned(t, str(tmp_path / "t"), ["id"], target=schema)
    assert scan_table(spark, str(tmp_path / "t")).count() == 4


def test_known_types_are_widened_not_narrowed(spark, tmp_path):
    path = write_text(tmp_path / "x.csv", "a,b,c,e\n1,x,2020-01-01,5\n")
    known = T.StructType().add("a", T.DoubleType()).add("b", T.IntegerType()).add("c", T.DateType()).add("e", T.DecimalType(38, 2)).add("f", T.LongType())
    tables, schema = scan_merged(spark, [path], known)
    assert [f.dataType.simpleString() for f in schema.fields] == ["double", "string", "date", "decimal(38,2)", "bigint"]
    assert tables[0].first().asDict() == {"a": 1.0, "b": "x", "c": __import__("datetime").date(2020, 1, 1), "e": 5, "f": None}
    assert fit(tables[0], schema).schema == schema
    assert widened(T.DecimalType(5, 2), 2) == T.DoubleType() and widened(T.BinaryType(), 2) == T.StringType()


def test_batches_are_stored_alike(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    for name, v in (("vendas_2", "1"), ("vendas_3", "1.5")):
        write_text(tmp_path / "lake" / "landingzone" / f"{name}.csv", f"VendasID,Quantidade\n1,{v}\n")
    bronze.ingest_sales_batches(spark, lake, ["vendas_2", "vendas_3"], infer=True)
    kinds = {scan_table(spark, lake.table("bronze", b)).schema.simpleString() for b in ("vendas_2", "vendas_3")}
    assert kinds == {"struct<VendasID:int,Quantidade:double>"}
    assert SALES == "vendas"


def test_empty_files(spark, tmp_path):
    tables, schema = scan_merged(spark, [write_text(tmp_path / "e.csv", "a,b\n")])
    assert tables[0].isEmpty() and [f.dataType for f in schema.fields] == [T.StringType(), T.StringType()]
