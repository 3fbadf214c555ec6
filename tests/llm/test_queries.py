"""Every registered query runs over whole tables; those with SQL give its rows."""

import pytest

from stratamart.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import connect, oracle_rows, rows_of

FOLDER = "/root/testdata/sf0.001"

# Rows for each document, page, or whatever the query says.
PER_DOCUMENT = ("op1_", "op2_", "op4_", "op5_", "op6_", "op7_", "op8_", "op13_")
# Others have a row per part and order of filters, or per vector.
WITHOUT_DOCUMENTS = ("op11_", "op12_")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_sql(spark, name):
    connection = connect(FOLDER)
    try:
        assert rows_of(QUERIES[name](spark, FOLDER)) == oracle_rows(connection, ORACLE_SQL[name])
    finally:
        connection.close()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(WITHOUT_DOCUMENTS)))
def test_query_covers_its_table(spark, name):
    df = QUERIES[name](spark, FOLDER)
    ids = [r[0] for r in df.select("page_id" if name.startswith("op3_") else "doc_id").collect()]
    table = "pages" if name.startswith("op3_") else "documents"
    whole = [r[0] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(f"{table[:-1].replace('document', 'doc')}_id").collect()]
    if name.startswith((*PER_DOCUMENT, "op3_")):
        assert sorted(ids) == sorted(whole)
    else:
        assert ids and set(ids) <= set(whole)
