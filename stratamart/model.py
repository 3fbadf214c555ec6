"""Names, types and places of the warehouse tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Table, column and constant names every consumer of the warehouse relies on.
SALES = "vendas"
PRODUCTS = "produtos"
CUSTOMERS = "clientes"
SELLERS = "vendedores"
CATEGORIES = "categorias"
CITIES = "cidades"
COUNTRIES = "paises"

LANDING_FILES = {
    CATEGORIES: "categorias.csv",
    PRODUCTS: "produtos.csv",
    CUSTOMERS: "clientes.csv",
    CITIES: "cidades.csv",
    COUNTRIES: "paises.csv",
    SELLERS: "vendedores.csv",
    SALES: "vendas_1.csv",
}

NAME_PARTS = ("PrimeiroNome", "NomeDoMeio", "UltimoNome")
FULL_NAME = "Nome"
TRANSACTION = "NumeroTransacao"
SALE_DATE = "DataVenda"
REGISTERED = "DataCadastro"
YEAR = "Ano"
MONTH = "Mes"
SALES_PARTITIONS = (YEAR, MONTH)
SALES_PARTITION_TYPES = {YEAR: T.IntegerType(), MONTH: T.IntegerType()}
# Lines of a landing file that do not have the declared types, as they were read.
UNREADABLE = "_linha_ilegivel"
FACT_COLUMNS = (
    "VendasID",
    "VendedorID",
    "ClienteID",
    "ProdutoID",
    "Quantidade",
    "PrecoUnitario",
    "Desconto",
    "PrecoTotal",
    "DataVenda",
)

VALID_FROM = "data_inicio"
VALID_TO = "data_fim"
ACTIVE = "registro_ativo"
OPEN_END = "9999-12-31"

# Money and quantities are exact decimals, so rounding never depends on binary fractions.
PRICE = T.DecimalType(12, 2)
QUANTITY = T.DecimalType(12, 2)
DISCOUNT = T.DecimalType(4, 2)
TOTAL = T.DecimalType(18, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Declared types of the columns the loads name; other columns of a file pass through.
DECLARED = {
    SALES: _struct(
        VendasID=T.LongType(),
        VendedorID=T.LongType(),
        ClienteID=T.LongType(),
        ProdutoID=T.LongType(),
        Quantidade=QUANTITY,
        Desconto=DISCOUNT,
        DataVenda=T.DateType(),
        NumeroTransacao=T.StringType(),
    ),
    PRODUCTS: _struct(ProdutoID=T.LongType(), Preco=PRICE, DataCadastro=T.DateType()),
    CUSTOMERS: _struct(
        ClienteID=T.LongType(),
        PrimeiroNome=T.StringType(),
        NomeDoMeio=T.StringType(),
        UltimoNome=T.StringType(),
    ),
    SELLERS: _struct(
        VendedorID=T.LongType(),
        PrimeiroNome=T.StringType(),
        NomeDoMeio=T.StringType(),
        UltimoNome=T.StringType(),
    ),
    CATEGORIES: _struct(),
    CITIES: _struct(),
    COUNTRIES: _struct(),
}


@dataclass(frozen=True)
class Dimension:
    """A dimension table: the key its source uses and the key the star schema uses."""

    table: str
    key: str
    sk: str


DIMENSIONS = {
    d.table: d
    for d in (
        Dimension(CUSTOMERS, "ClienteID", "SK_Cliente"),
        Dimension(SELLERS, "VendedorID", "SK_Vendedor"),
        Dimension(PRODUCTS, "ProdutoID", "SK_Produto"),
        Dimension(CATEGORIES, "CategoriaID", "SK_Categoria"),
        Dimension(CITIES, "CidadeID", "SK_Cidade"),
        Dimension(COUNTRIES, "PaisID", "SK_Pais"),
    )
}

# The dimensions whose natural keys the sales table carries, in the order they are swapped.
FACT_DIMENSIONS = tuple(DIMENSIONS[t] for t in (CUSTOMERS, SELLERS, PRODUCTS))


@dataclass(frozen=True)
class Lake:
    """Base folder of each layer and the format its tables are stored in."""

    landing: str
    bronze: str
    silver: str
    gold: str
    fmt: str = "parquet"
    landing_files: dict[str, str] = field(default_factory=lambda: dict(LANDING_FILES))

    @classmethod
    def under(cls, root: str, fmt: str = "parquet") -> Lake:
        return cls(*(f"{root}/{layer}" for layer in ("landingzone", "bronze", "silver", "gold")), fmt)

    def landing_file(self, table: str) -> str:
        return f"{self.landing}/{self.landing_files.get(table, table + '.csv')}"

    def table(self, layer: str, name: str) -> str:
        return f"{getattr(self, layer)}/{name}"
