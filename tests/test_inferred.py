"""Members that sales name before their source does."""

from stratamart.model import CUSTOMERS, DIMENSIONS, Lake
from stratamart.operators.inferred import inferred_members, take_over
from stratamart.plans import gold
from stratamart.sinks.tables import overwrite
from stratamart.sources.tables import scan_table
from tests.frames import day

SPEC = DIMENSIONS[CUSTOMERS]
SCHEMA = "ClienteID bigint, Nome string, CidadeID int, SK_Cliente bigint, data_inicio date, data_fim date, registro_ativo int"


def dimension(spark, rows):
    return spark.createDataFrame([(k, n, c, sk, day(a), day(b), active) for k, n, c, sk, a, b, active in rows], SCHEMA)


def used(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "ClienteID bigint")


HELD = [(1, "a", 1, 1, "2020-01-01", "9999-12-31", 1), (2, "b", 1, 2, "2020-01-01", "2020-02-01", 0), (2, "c", 1, 3, "2020-02-01", "9999-12-31", 1)]


def test_only_unknown_keys_get_members(spark):
    # A third of all facts use one unknown key.
    facts = used(spark, [9] * 100 + [1, 2, None, 7] * 50)
    found = inferred_members(dimension(spark, HELD), facts, SPEC, "2020-03-01").collect()
    assert [(r.ClienteID, r.Nome, r.SK_Cliente, str(r.data_inicio), r.registro_ativo) for r in found] == [
        (7, None, 4, "2020-03-01", 1), (9, None, 5, "2020-03-01", 1)
    ]
    assert inferred_members(dimension(spark, HELD), used(spark, [1]), SPEC, "2020-03-01").isEmpty()
    assert inferred_members(dimension(spark, []), used(spark, [3]), SPEC, "2020-03-01").first().SK_Cliente == 1


def test_real_rows_take_members_over_under_the_same_key(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    members = [(7, None, None, 4, "2020-03-01", "9999-12-31", 1), (9, None, None, 5, "2020-03-01", "9999-12-31", 1)]
    overwrite(dimension(spark, HELD + members), lake.table("gold", CUSTOMERS))
    extract = spark.createDataFrame([(1, "a", 1), (2, "d", 1), (7, "g", 2)], "ClienteID bigint, Nome string, CidadeID int")
    overwrite(extract, lake.table("silver", CUSTOMERS))
    gold.update_dimension(spark, lake, SPEC, "2020-04-01")
    rows = scan_table(spark, lake.table("gold", CUSTOMERS)).collect()
    assert {(r.ClienteID, r.Nome, r.SK_Cliente, str(r.data_inicio), r.registro_ativo) for r in rows} == {
        (1, "a", 1, "2020-01-01", 1), (2, "b", 2, "2020-01-01", 0), (2, "c", 3, "2020-02-01", 0), (2, "d", 6, "2020-04-01", 1),
        (7, "g", 4, "2020-03-01", 1), (9, None, 5, "2020-03-01", 1),
    }
    # From then on a change is a change.
    overwrite(extract.replace("g", "h", "Nome"), lake.table("silver", CUSTOMERS))
    gold.update_dimension(spark, lake, SPEC, "2020-05-01")
    rows = scan_table(spark, lake.table("gold", CUSTOMERS)).filter("ClienteID = 7").collect()
    assert {(r.Nome, r.SK_Cliente, r.registro_ativo) for r in rows} == {("g", 4, 0), ("h", 7, 1)}


def test_take_over_leaves_all_else(spark):
    extract = spark.createDataFrame([(1, "z", 9)], "ClienteID bigint, Nome string, CidadeID int")
    held = dimension(spark, HELD)
    assert sorted(take_over(held, extract, SPEC).collect()) == sorted(held.collect())
