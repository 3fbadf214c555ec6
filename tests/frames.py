"""Small hand-made tables."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


def day(text: str | None) -> date | None:
    return None if text is None else date.fromisoformat(text)


def money(text: str | None) -> Decimal | None:
    return None if text is None else Decimal(text)


def sales(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (sale, product, date[, quantity, discount])."""
    full = [(i, 1, 1, p, money(q), money(d), day(on), f"t{i}") for i, p, on, q, d in (r + ("1", "0")[len(r) - 3 :] for r in rows)]
    return spark.createDataFrame(
        full,
        "VendasID bigint, VendedorID bigint, ClienteID bigint, ProdutoID bigint, Quantidade decimal(12,2),"
        " Desconto decimal(4,2), DataVenda date, NumeroTransacao string",
    )


def products(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (product, price, registered)."""
    return spark.createDataFrame(
        [(p, money(price), day(on)) for p, price, on in rows],
        "ProdutoID bigint, Preco decimal(12,2), DataCadastro date",
    )


def write_text(path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def plan_of(df: DataFrame, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out
