"""The given test tables, seen as the tables of the sales model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.model import DISCOUNT, PRICE, QUANTITY

# Date ranges of the three sales batches, end exclusive. The second overlaps the first, so that the
# high-water mark has rows to drop.
BATCHES = {
    "vendas_1": (None, "1999-07-01"),
    "vendas_2": ("1999-01-01", "2000-01-01"),
    "vendas_3": ("2000-01-01", None),
}


class Tables:
    """Sales-model views over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _order_lines(self, batch: str | None) -> DataFrame:
        lines = self.read("lineitem")
        since, until = BATCHES[batch] if batch else (None, None)
        if since:
            lines = lines.filter(F.col("l_shipdate") >= F.lit(since).cast("timestamp_ntz"))
        if until:
            lines = lines.filter(F.col("l_shipdate") < F.lit(until).cast("timestamp_ntz"))
        return lines.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("VendasID"),
            F.col("l_suppkey").alias("VendedorID"),
            F.col("l_partkey").alias("ProdutoID"),
            F.col("l_quantity").cast(QUANTITY).alias("Quantidade"),
            F.col("l_discount").cast(DISCOUNT).alias("Desconto"),
            F.to_date("l_shipdate").alias("DataVenda"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("NumeroTransacao"),
            F.col("l_orderkey").alias("_order"),
        )

    def sales(self, batch: str | None = None) -> DataFrame:
        """Sales, or those of one batch, with their customer, whom only the orders know."""
        orders = self.read("orders").select(
            F.col("o_orderkey").alias("_order"), F.col("o_custkey").alias("ClienteID")
        )
        return (
            self._order_lines(batch)
            .join(orders, "_order", "left")
            .select(
                "VendasID", "VendedorID", "ClienteID", "ProdutoID",
                "Quantidade", "Desconto", "DataVenda", "NumeroTransacao",
            )
        )

    def products(self) -> DataFrame:
        registered = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_partkey") % 1000).cast("int"))
        return self.read("part").select(
            F.col("p_partkey").alias("ProdutoID"),
            F.col("p_name").alias("Produto"),
            F.col("p_type").alias("CategoriaID"),
            F.col("p_retailprice").cast(PRICE).alias("Preco"),
            registered.alias("DataCadastro"),
        )

    def price_history(self) -> DataFrame:
        """Three prices per product, 400 days and ten units of money apart."""
        step = F.explode(F.array(*(F.lit(n) for n in range(3)))).alias("_step")
        return self.products().select("ProdutoID", "Preco", "DataCadastro", step).select(
            "ProdutoID",
            (F.col("Preco") + F.col("_step") * 10).cast(PRICE).alias("Preco"),
            F.date_add("DataCadastro", F.col("_step") * 400).alias("DataCadastro"),
        )

    def customers(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("ClienteID"),
            F.substring_index("c_name", "#", 1).alias("PrimeiroNome"),
            F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("NomeDoMeio"),
            F.substring_index("c_name", "#", -1).alias("UltimoNome"),
            F.col("c_nationkey").alias("CidadeID"),
            F.col("c_acctbal").cast("decimal(12,2)").alias("Saldo"),
        )

    def sellers(self) -> DataFrame:
        return self.read("supplier").select(
            F.col("s_suppkey").alias("VendedorID"),
            F.substring_index("s_name", "#", 1).alias("PrimeiroNome"),
            F.lit(None).cast("string").alias("NomeDoMeio"),
            F.substring_index("s_name", "#", -1).alias("UltimoNome"),
            F.col("s_nationkey").alias("CidadeID"),
        )

    def categories(self) -> DataFrame:
        return self.read("part").select(F.col("p_type").alias("CategoriaID")).distinct()

    def cities(self) -> DataFrame:
        return self.read("nation").select(
            F.col("n_nationkey").alias("CidadeID"), F.col("n_name").alias("Cidade"), F.col("n_regionkey").alias("PaisID")
        )

    def countries(self) -> DataFrame:
        return self.read("region").select(F.col("r_regionkey").alias("PaisID"), F.col("r_name").alias("Pais"))
