"""Counts of rows that break a rule of the model."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.operators.shaping import stack
from stratamart.workspace import materialize


def null_values(df: DataFrame, table: str, columns: Iterable[str]) -> DataFrame:
    """Rows with a null, per column, in one pass."""
    columns = list(columns)
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    pairs = F.array(*(F.struct(F.lit(f"nulo:{c}").alias("regra"), F.col(c).alias("linhas")) for c in columns))
    return counts.select(F.lit(table).alias("tabela"), F.inline(pairs))


def duplicate_keys(df: DataFrame, table: str, key: str) -> DataFrame:
    """How many key values occur more than once."""
    repeated = df.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")
    return _result(repeated, table, f"duplicado:{key}", F.count("*"))


def orphans(df: DataFrame, table: str, key: str, parent: DataFrame) -> DataFrame:
    """Rows whose key the parent table does not have.

    Rows are counted per key before the join, so a hot key crosses the network as one row.
    """
    used = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    lost = used.join(parent.select(key), key, "left_anti")
    return _result(lost, table, f"orfao:{key}", F.coalesce(F.sum("_rows"), F.lit(0)))


def key_checks(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows without the key and key values that occur more than once, from one count per key."""
    counts = df.groupBy(key).agg(F.count("*").alias("_rows"))
    missing = F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_rows"))), F.lit(0)).cast("bigint").alias("nulo")
    repeated = F.count_if(F.col(key).isNotNull() & (F.col("_rows") > 1)).alias("duplicado")
    rules = [F.struct(F.lit(f"{rule}:{key}").alias("regra"), F.col(rule).alias("linhas")) for rule in ("nulo", "duplicado")]
    return counts.agg(missing, repeated).select(F.lit(table).alias("tabela"), F.inline(F.array(*rules)))


def key_uses(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """How many rows of ``df`` use each value of each key, in one pass: _key, _value, _rows."""
    used = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(k).cast("string").alias("v")) for k in keys)))
    values = df.select(used.alias("_used")).select(F.col("_used.k").alias("_key"), F.col("_used.v").alias("_value"))
    return values.where("_value IS NOT NULL").groupBy("_key", "_value").agg(F.count("*").alias("_rows"))


def quality_report(
    sales: DataFrame, sales_table: str, parents: Mapping[str, tuple[str, DataFrame]]
) -> DataFrame:
    """One row per table and rule: null prices and dates, duplicate keys, orphaned keys.

    ``parents`` maps the key a parent table is joined on to the table's name and rows. The sales are read
    three times, for nulls, for their own key and for all keys they point with, whose counts are stored as
    each is joined to its parent; a parent is read once for its key and once for that join.
    """
    checks = [
        null_values(sales, sales_table, ["PrecoUnitario", "PrecoTotal", "DataVenda"]),
        duplicate_keys(sales, sales_table, "VendasID"),
    ]
    pointing = [key for key in parents if key in sales.columns]
    uses = materialize(key_uses(sales, pointing), "uses") if pointing else None
    for key, (table, rows) in parents.items():
        if key in pointing:
            own = uses.where(F.col("_key") == key)
            lost = own.join(rows.select(F.col(key).cast("string").alias("_value")), "_value", "left_anti")
            checks.append(_result(lost, sales_table, f"orfao:{key}", F.coalesce(F.sum("_rows"), F.lit(0))))
        checks.append(key_checks(rows, table, key))
    return stack(*checks)


def _result(df: DataFrame, table: str, rule: str, amount) -> DataFrame:
    return df.agg(amount.cast("bigint").alias("linhas")).select(
        F.lit(table).alias("tabela"), F.lit(rule).alias("regra"), "linhas"
    )
