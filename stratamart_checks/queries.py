"""One query per operator or load, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart_checks.views import Tables
from stratamart.model import (
    CATEGORIES,
    CITIES,
    COUNTRIES,
    CUSTOMERS,
    DECLARED,
    DIMENSIONS,
    FACT_DIMENSIONS,
    PRODUCTS,
    SALES,
    SALES_PARTITIONS,
    SELLERS,
    TRANSACTION,
    UNREADABLE,
    Lake,
)
from stratamart.operators.asof import price_as_of_time
from stratamart.operators.audit import load_audit
from stratamart.operators.dimensions import first_load, merge_changes
from stratamart.operators.history_check import history_faults
from stratamart.operators.keys import extend_keys, number_rows
from stratamart.operators.lookup import current_versions, swap_keys, swap_keys_at_date
from stratamart.operators.pricing import conform_sales, price_as_of, price_by_product, with_calendar, with_totals
from stratamart.operators.quality import quality_report
from stratamart.operators.reconcile import differences
from stratamart.operators.shaping import merge_names, move_after, stack
from stratamart.operators.watermark import high_watermark, newer_than, read_watermark
from stratamart.plans import bronze, gold, incremental, silver
from stratamart.plans.report import sales_by_month as monthly
from stratamart.sinks.staged import stage, staging_of
from stratamart.sinks.tables import append_partitioned, overwrite, overwrite_partitioned
from stratamart.sources.landing import scan_csv
from stratamart.sources.merged import scan_merged
from stratamart.sources.tables import scan_partition, scan_table, scan_table_if_present
from stratamart.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NEW_BATCHES = ("vendas_2", "vendas_3")

# Load dates fall inside the span of the sales, so that both versions of a customer are in use.
FIRST_LOAD = "1996-01-01"
BETWEEN = "1997-03-01"
SECOND_LOAD = "1998-06-01"


def query(name: str) -> Callable[[Callable[[Tables], DataFrame]], None]:
    """Register the decorated function under ``name``."""

    def register(build: Callable[[Tables], DataFrame]) -> None:
        QUERIES[name] = lambda spark, folder: comparable(build(Tables(spark, folder)))

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as ISO text, which Spark and other engines hand out alike."""
    shown = []
    for f in df.schema.fields:
        column = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            column = column.cast("double").alias(f.name)
        elif isinstance(f.dataType, (T.DateType, T.TimestampNTZType)):
            column = column.cast("string").alias(f.name)
        shown.append(column)
    return df.select(*shown)


def new_lake(t: Tables) -> Lake:
    return Lake.under(new_folder(t.spark, "lake"))


def land(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def land_dimensions(t: Tables, lake: Lake) -> None:
    for table, rows in dimension_sources(t).items():
        land(rows, lake.landing_file(table))


def dimension_sources(t: Tables) -> dict[str, DataFrame]:
    return {
        CATEGORIES: t.categories(),
        PRODUCTS: t.products(),
        CUSTOMERS: t.customers(),
        CITIES: t.cities(),
        COUNTRIES: t.countries(),
        SELLERS: t.sellers(),
    }


# --- sources -----------------------------------------------------------------------------------


@query("bronze_csv_scan")
def bronze_csv_scan(t: Tables) -> DataFrame:
    lake = new_lake(t)
    land(t.sales(), lake.landing_file(SALES))
    return scan_csv(t.spark, lake.landing_file(SALES), DECLARED[SALES])


@query("bronze_csv_batches")
def bronze_csv_batches(t: Tables) -> DataFrame:
    lake = new_lake(t)
    for batch in NEW_BATCHES:
        land(t.sales(batch), lake.landing_file(batch))
    bronze.ingest_sales_batches(t.spark, lake, NEW_BATCHES)
    return stack(*(scan_table(t.spark, lake.table("bronze", b)).drop(UNREADABLE) for b in NEW_BATCHES))


@query("table_scan")
def table_scan(t: Tables) -> DataFrame:
    return scan_table(t.spark, f"{t.folder}/lineitem.parquet")


@query("partition_scan")
def partition_scan(t: Tables) -> DataFrame:
    path = new_folder(t.spark, SALES)
    overwrite_partitioned(with_calendar(t.sales()), path, SALES_PARTITIONS)
    return scan_partition(t.spark, path, Ano=1998, Mes=1)


@query("csv_merged_types")
def csv_merged_types(t: Tables) -> DataFrame:
    """Three batches that look different: whole numbers then fractions, days then moments, numbers then text."""
    lake = new_lake(t)
    moment = F.date_format(F.col("DataVenda").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    shown = {
        "vendas_1": (F.col("Quantidade").cast("int"), F.col("DataVenda").cast("string"), F.col("ProdutoID")),
        "vendas_2": (F.col("Quantidade") + F.lit("0.25").cast("decimal(3,2)"), moment, F.col("ProdutoID") + (1 << 40)),
        "vendas_3": (F.col("Quantidade").cast("int"), moment, F.col("NumeroTransacao")),
    }
    for batch, (quantity, sold, code) in shown.items():
        land(
            t.sales(batch).select("VendasID", quantity.alias("Quantidade"), sold.alias("DataVenda"), code.alias("Codigo")),
            lake.landing_file(batch),
        )
    batches, schema = scan_merged(t.spark, [lake.landing_file(b) for b in shown])
    path = new_folder(t.spark, SALES)
    for rows in batches:
        append_partitioned(with_calendar(rows), path, SALES_PARTITIONS, target=with_calendar(rows).schema)
    return scan_table(t.spark, path)


# --- sinks -------------------------------------------------------------------------------------


@query("overwrite_roundtrip")
def overwrite_roundtrip(t: Tables) -> DataFrame:
    path = new_folder(t.spark, CUSTOMERS)
    overwrite(t.sellers(), path)
    overwrite(t.customers(), path)
    return scan_table(t.spark, path)


@query("partitioned_overwrite")
def partitioned_overwrite(t: Tables) -> DataFrame:
    path = new_folder(t.spark, SALES)
    overwrite_partitioned(with_calendar(t.sales()), path, ("ano", "mes"))
    return scan_table(t.spark, path)


@query("partitioned_append")
def partitioned_append(t: Tables) -> DataFrame:
    path = new_folder(t.spark, SALES)
    overwrite_partitioned(with_calendar(t.sales("vendas_1")), path, SALES_PARTITIONS)
    held = scan_table(t.spark, path).schema
    for batch in NEW_BATCHES:
        append_partitioned(with_calendar(t.sales(batch)), path, SALES_PARTITIONS, target=held)
    return scan_table(t.spark, path)


# --- projections and filters -------------------------------------------------------------------


@query("drop_columns")
def drop_columns(t: Tables) -> DataFrame:
    return t.customers().drop("PrimeiroNome", "NomeDoMeio", "UltimoNome", "NotThere")


@query("fact_column_order")
def fact_column_order(t: Tables) -> DataFrame:
    priced = price_by_product(t.sales().drop(TRANSACTION), t.products())
    return with_totals(priced.select(*reversed(priced.columns)))


@query("reorder_after_key")
def reorder_after_key(t: Tables) -> DataFrame:
    return move_after(t.cities().select("Cidade", "CidadeID", "PaisID"), "PaisID", "CidadeID")


@query("filter_equality")
def filter_equality(t: Tables) -> DataFrame:
    return t.products().filter(F.col("ProdutoID") == 101).select("ProdutoID", "DataCadastro")


@query("incremental_filter")
def incremental_filter(t: Tables) -> DataFrame:
    mark = read_watermark(t.sales("vendas_1"))
    return newer_than(stack(*map(t.sales, NEW_BATCHES)), mark)


@query("incremental_bootstrap")
def incremental_bootstrap(t: Tables) -> DataFrame:
    absent = scan_table_if_present(t.spark, new_folder(t.spark, SALES))
    return newer_than(t.sales(), read_watermark(absent))


# --- joins, aggregate, union -------------------------------------------------------------------


@query("price_lookup_join")
def price_lookup_join(t: Tables) -> DataFrame:
    return price_by_product(t.sales(), t.products())


@query("fact_sk_lookup")
def fact_sk_lookup(t: Tables) -> DataFrame:
    sources = dimension_sources(t)
    dimensions = [(spec, number_rows(sources[spec.table], spec.key, spec.sk)) for spec in FACT_DIMENSIONS]
    return swap_keys(t.sales().drop(TRANSACTION), dimensions)


@query("high_watermark")
def high_watermark_of_sales(t: Tables) -> DataFrame:
    path = new_folder(t.spark, SALES)
    overwrite_partitioned(with_calendar(t.sales()), path, SALES_PARTITIONS)
    return high_watermark(scan_table(t.spark, path))


@query("union_batches")
def union_batches(t: Tables) -> DataFrame:
    second, third = map(t.sales, NEW_BATCHES)
    return stack(second, third.select(*reversed(third.columns)))


# --- layers ------------------------------------------------------------------------------------


@query("bronze_ingest")
def bronze_ingest(t: Tables) -> DataFrame:
    """Every value of the seven bronze tables after a landing-zone ingest, one text per row."""
    lake = new_lake(t)
    land_dimensions(t, lake)
    land(t.sales(), lake.landing_file(SALES))
    bronze.ingest(t.spark, lake)
    return stack(*(_lines(scan_table(t.spark, lake.table("bronze", n)), n) for n in [*dimension_sources(t), SALES]))


def _lines(df: DataFrame, table: str) -> DataFrame:
    return df.select(F.lit(table).alias("tabela"), F.concat_ws("|", *df.columns).alias("linha"))


@query("silver_customers")
def silver_customers(t: Tables) -> DataFrame:
    return merge_names(t.customers(), "ClienteID")


@query("silver_sellers")
def silver_sellers(t: Tables) -> DataFrame:
    return merge_names(t.sellers(), "VendedorID")


@query("silver_passthrough")
def silver_passthrough(t: Tables) -> DataFrame:
    """Every value of the four tables silver takes over unchanged, one text per row."""
    lake = new_lake(t)
    sources = dimension_sources(t)
    for table in (*silver.UNCHANGED, CUSTOMERS, SELLERS):
        overwrite(sources[table], lake.table("bronze", table))
    silver.build_dimensions(t.spark, lake)
    return stack(*(_lines(scan_table(t.spark, lake.table("silver", n)), n) for n in silver.UNCHANGED))


@query("silver_sales")
def silver_sales(t: Tables) -> DataFrame:
    return conform_sales(t.sales(), t.products())


@query("silver_sales_load")
def silver_sales_load(t: Tables) -> DataFrame:
    """From the landing zone through bronze to the stored silver table, by the loads themselves."""
    lake = new_lake(t)
    land_dimensions(t, lake)
    land(t.sales(), lake.landing_file(SALES))
    bronze.ingest(t.spark, lake, (PRODUCTS, SALES))
    silver.build_sales(t.spark, lake)
    return scan_table(t.spark, lake.table("silver", SALES))


def _gold_dimension(table: str) -> Callable[[Tables], DataFrame]:
    def build(t: Tables) -> DataFrame:
        rows = dimension_sources(t)[table]
        if table in silver.PERSONS:
            rows = merge_names(rows, silver.PERSONS[table])
        return first_load(rows, DIMENSIONS[table], FIRST_LOAD)

    return build


for _name, _table in {
    "gold_dim_customer": CUSTOMERS,
    "gold_dim_seller": SELLERS,
    "gold_dim_product": PRODUCTS,
    "gold_dim_category": CATEGORIES,
    "gold_dim_city": CITIES,
    "gold_dim_country": COUNTRIES,
}.items():
    query(_name)(_gold_dimension(_table))


@query("gold_sales")
def gold_sales(t: Tables) -> DataFrame:
    """The load from stored silver tables to the stored fact, by the keys of the stored dimensions."""
    lake = new_lake(t)
    _gold_load(t, lake)
    return scan_table(t.spark, lake.table("gold", SALES))


def _gold_load(t: Tables, lake: Lake) -> None:
    sources = dimension_sources(t)
    for spec in FACT_DIMENSIONS:
        overwrite(sources[spec.table], lake.table("silver", spec.table))
    overwrite_partitioned(conform_sales(t.sales(), t.products()), lake.table("silver", SALES), SALES_PARTITIONS)
    gold.build(t.spark, lake, FIRST_LOAD, FACT_DIMENSIONS)


def _first_silver_load(t: Tables, lake: Lake) -> None:
    overwrite(t.products(), lake.table("bronze", PRODUCTS))
    priced = conform_sales(t.sales("vendas_1"), t.products())
    overwrite_partitioned(priced, lake.table("silver", SALES), SALES_PARTITIONS)


def _append_new_batches(t: Tables, lake: Lake) -> None:
    for batch in NEW_BATCHES:
        overwrite(t.sales(batch), lake.table("bronze", batch))
    incremental.append_sales(t.spark, lake, NEW_BATCHES)


@query("incremental_silver_sales")
def incremental_silver_sales(t: Tables) -> DataFrame:
    lake = new_lake(t)
    _first_silver_load(t, lake)
    _append_new_batches(t, lake)
    return scan_table(t.spark, lake.table("silver", SALES))


# --- history, quality, audit -------------------------------------------------------------------


@query("surrogate_keys")
def surrogate_keys(t: Tables) -> DataFrame:
    """Early buyers already have keys; all customers are then keyed, the early ones unchanged."""
    known = number_rows(_early_customers(t).select("ClienteID"), "ClienteID", "SK_Cliente")
    return extend_keys(known, t.customers().select("ClienteID"), "ClienteID", "SK_Cliente")


def _early_customers(t: Tables) -> DataFrame:
    early = t.read("orders").filter(F.col("o_orderdate") < F.lit("1995-06-01").cast("timestamp_ntz"))
    return t.customers().join(early, F.col("ClienteID") == F.col("o_custkey"), "left_semi")


def _dimension_of_early_customers(t: Tables) -> DataFrame:
    return first_load(merge_names(_early_customers(t), "ClienteID"), DIMENSIONS[CUSTOMERS], FIRST_LOAD)


def _later_extract(t: Tables) -> DataFrame:
    """All accounts still open; some customers moved, some lost or gained a city."""
    balance = F.col("Saldo")
    city = (
        F.when(balance >= 9000, F.col("CidadeID") + 1)
        .when((balance >= 8000) & (balance < 8500), F.lit(None).cast("int"))
        .otherwise(F.col("CidadeID"))
    )
    return merge_names(t.customers(), "ClienteID").filter(balance >= 0).withColumn("CidadeID", city)


def _merged_customers(t: Tables) -> DataFrame:
    return merge_changes(_dimension_of_early_customers(t), _later_extract(t), DIMENSIONS[CUSTOMERS], SECOND_LOAD)


@query("scd2_merge")
def scd2_merge(t: Tables) -> DataFrame:
    """The load that merges a stored silver table into a stored dimension."""
    lake, spec = new_lake(t), DIMENSIONS[CUSTOMERS]
    overwrite(merge_names(_early_customers(t), "ClienteID"), lake.table("silver", CUSTOMERS))
    gold.build_dimension(t.spark, lake, spec, FIRST_LOAD)
    overwrite(_later_extract(t), lake.table("silver", CUSTOMERS))
    gold.update_dimension(t.spark, lake, spec, SECOND_LOAD)
    return scan_table(t.spark, lake.table("gold", CUSTOMERS))


@query("scd2_stored_apart")
def scd2_stored_apart(t: Tables) -> DataFrame:
    """As scd2_merge, of a dimension whose ended versions are stored apart and never written again."""
    lake, spec = new_lake(t), DIMENSIONS[CUSTOMERS]
    overwrite(merge_names(_early_customers(t), "ClienteID"), lake.table("silver", CUSTOMERS))
    gold.build_dimension(t.spark, lake, spec, FIRST_LOAD, apart=True)
    overwrite(_later_extract(t), lake.table("silver", CUSTOMERS))
    gold.update_dimension(t.spark, lake, spec, SECOND_LOAD)
    return scan_table(t.spark, lake.table("gold", CUSTOMERS))


def _extract_in_between(t: Tables) -> DataFrame:
    """What the customers looked like between the two other extracts, some of them unknown then."""
    balance = F.col("Saldo")
    city = F.when(balance >= 8800, F.col("CidadeID") + 2).otherwise(F.col("CidadeID"))
    return merge_names(t.customers(), "ClienteID").filter(balance >= 2000).withColumn("CidadeID", city)


@query("scd2_backdated")
def scd2_backdated(t: Tables) -> DataFrame:
    """Three extracts of customers, the middle one loaded last: the history of the ordered loads."""
    lake, spec = new_lake(t), DIMENSIONS[CUSTOMERS]
    overwrite(merge_names(_early_customers(t), "ClienteID"), lake.table("silver", CUSTOMERS))
    gold.build_dimension(t.spark, lake, spec, FIRST_LOAD, remember=True)
    for extract, day in ((_later_extract(t), SECOND_LOAD), (_extract_in_between(t), BETWEEN)):
        overwrite(extract, lake.table("silver", CUSTOMERS))
        gold.update_dimension(t.spark, lake, spec, day, remember=True)
    return scan_table(t.spark, lake.table("gold", CUSTOMERS)).drop(spec.sk)


@query("scd2_change_feed")
def scd2_change_feed(t: Tables) -> DataFrame:
    """Customers by the priority of their last order: every order is a change, several a customer."""
    lake, spec = new_lake(t), DIMENSIONS[CUSTOMERS]
    known = t.customers().select("ClienteID", F.lit("NENHUMA").alias("Prioridade"))
    overwrite(known, lake.table("silver", CUSTOMERS))
    gold.build_dimension(t.spark, lake, spec, FIRST_LOAD)
    orders = t.read("orders").select(
        F.col("o_custkey").alias("ClienteID"), F.col("o_orderpriority").alias("Prioridade"), "o_orderdate", "o_orderkey"
    )
    gold.apply_changes(t.spark, lake, spec, orders, "o_orderdate", "o_orderkey")
    return scan_table(t.spark, lake.table("gold", CUSTOMERS)).drop(spec.sk)


@query("price_asof_join")
def price_asof_join(t: Tables) -> DataFrame:
    return price_as_of(t.sales(), t.price_history())


@query("price_asof_time")
def price_asof_time(t: Tables) -> DataFrame:
    """Sales and prices with a time of day; two prices on each day on which one is registered."""
    moment = "timestampadd(SECOND, {} % 86400, CAST({} AS timestamp_ntz))"
    sales = t.sales().withColumn("DataHora", F.expr(moment.format("VendasID * 7919", "DataVenda")))
    twice = F.explode(F.array(F.lit(0), F.lit(1))).alias("_again")
    prices = t.price_history().select("ProdutoID", "Preco", "DataCadastro", twice).select(
        "ProdutoID",
        (F.col("Preco") + F.col("_again")).cast("decimal(12,2)").alias("Preco"),
        F.expr(moment.format("(ProdutoID * 613 + _again * 30011)", "DataCadastro")).alias("DataCadastro"),
    )
    return price_as_of_time(sales, prices, "DataHora").drop("DataVenda")


@query("history_check")
def history_check(t: Tables) -> DataFrame:
    """The merged customers with planted faults: ends moved both ways, versions opened again, keys lost."""
    key, ended = F.col("ClienteID"), F.col("registro_ativo") == 0
    moved = F.when(ended & (key % 4 == 0), F.date_add("data_fim", 30)).when(ended & (key % 4 == 1), F.date_sub("data_fim", 30))
    moved = moved.when(~ended & (key % 10 == 7), F.col("data_inicio")).otherwise(F.col("data_fim"))
    active = F.when(ended & (key % 4 == 2), 1).otherwise(F.col("registro_ativo"))
    faulty = _merged_customers(t).withColumns({"data_fim": moved, "registro_ativo": active})
    faulty = faulty.withColumn("SK_Cliente", F.when(key % 25 != 3, F.col("SK_Cliente")).otherwise(1))
    return history_faults(faulty, DIMENSIONS[CUSTOMERS])


@query("gold_inferred_members")
def gold_inferred_members(t: Tables) -> DataFrame:
    """Sales of customers whose rows come later have a key from the start, and keep it when they have come."""
    lake, spec = new_lake(t), DIMENSIONS[CUSTOMERS]
    sources = dimension_sources(t)
    overwrite(_dimension_of_early_customers(t), lake.table("gold", CUSTOMERS))
    for other in (DIMENSIONS[SELLERS], DIMENSIONS[PRODUCTS]):
        overwrite(first_load(sources[other.table], other, FIRST_LOAD), lake.table("gold", other.table))
    overwrite_partitioned(conform_sales(t.sales(), t.products()), lake.table("silver", SALES), SALES_PARTITIONS)
    gold.infer_members(t.spark, lake, load_date=FIRST_LOAD)
    gold.build_sales(t.spark, lake)
    overwrite(merge_names(t.customers(), "ClienteID"), lake.table("silver", CUSTOMERS))
    gold.update_dimension(t.spark, lake, spec, SECOND_LOAD)
    gold.refresh_sales(t.spark, lake)
    fact = scan_table(t.spark, lake.table("gold", SALES))
    names = scan_table(t.spark, lake.table("gold", CUSTOMERS)).select("SK_Cliente", "ClienteID", "Nome", "data_inicio")
    return fact.select("VendasID", "SK_Cliente").join(names, "SK_Cliente", "left")


@query("fact_sk_point_in_time")
def fact_sk_point_in_time(t: Tables) -> DataFrame:
    lake = new_lake(t)
    overwrite(_merged_customers(t), lake.table("gold", CUSTOMERS))
    for spec, source in ((DIMENSIONS[SELLERS], t.sellers()), (DIMENSIONS[PRODUCTS], t.products())):
        overwrite(first_load(source, spec, FIRST_LOAD), lake.table("gold", spec.table))
    return swap_keys_at_date(t.sales().drop(TRANSACTION), gold.stored_dimensions(t.spark, lake))


@query("fact_sk_current")
def fact_sk_current(t: Tables) -> DataFrame:
    lake = new_lake(t)
    overwrite(_merged_customers(t), lake.table("gold", CUSTOMERS))
    for spec, source in ((DIMENSIONS[SELLERS], t.sellers()), (DIMENSIONS[PRODUCTS], t.products())):
        overwrite(first_load(source, spec, FIRST_LOAD), lake.table("gold", spec.table))
    stored = gold.stored_dimensions(t.spark, lake)
    return swap_keys(t.sales().drop(TRANSACTION), [(spec, current_versions(rows)) for spec, rows in stored])


@query("gold_incremental_refresh")
def gold_incremental_refresh(t: Tables) -> DataFrame:
    lake = new_lake(t)
    sources = dimension_sources(t)
    for spec in FACT_DIMENSIONS:
        overwrite(first_load(sources[spec.table], spec, FIRST_LOAD), lake.table("gold", spec.table))
    _first_silver_load(t, lake)
    gold.build_sales(t.spark, lake)
    _append_new_batches(t, lake)
    gold.refresh_sales(t.spark, lake)
    return scan_table(t.spark, lake.table("gold", SALES))


@query("append_after_break")
def append_after_break(t: Tables) -> DataFrame:
    """A load that broke off when its batch was staged, and another before, are made good by the next load."""
    lake = new_lake(t)
    _first_silver_load(t, lake)
    target = lake.table("silver", SALES)
    mark = read_watermark(scan_table(t.spark, target))
    second = conform_sales(newer_than(t.sales("vendas_2"), mark), t.products())
    stage(second, target, SALES_PARTITIONS)
    overwrite(second, f"{staging_of(target)}/broken.writing")
    _append_new_batches(t, lake)
    return scan_table(t.spark, target)


@query("refresh_months")
def refresh_months(t: Tables) -> DataFrame:
    """Months that a refresh reads after new batches and a later customer load: by new sales, and by versions in use."""
    lake = new_lake(t)
    sources = dimension_sources(t)
    overwrite(_dimension_of_early_customers(t), lake.table("gold", CUSTOMERS))
    for spec in (DIMENSIONS[SELLERS], DIMENSIONS[PRODUCTS]):
        overwrite(first_load(sources[spec.table], spec, FIRST_LOAD), lake.table("gold", spec.table))
    _first_silver_load(t, lake)
    gold.build_sales(t.spark, lake)
    _append_new_batches(t, lake)
    overwrite(_later_extract(t), lake.table("silver", CUSTOMERS))
    gold.update_dimension(t.spark, lake, DIMENSIONS[CUSTOMERS], SECOND_LOAD)
    return gold.months_to_refresh(t.spark, lake).select(*SALES_PARTITIONS, "vendas_mudaram", "versoes_mudaram")


@query("dq_summary")
def dq_summary(t: Tables) -> DataFrame:
    """Sales and the tables they point to, each whole; a price table with several rows per product has duplicates."""
    path = new_folder(t.spark, SALES)
    overwrite_partitioned(conform_sales(t.sales(), t.products()), path, SALES_PARTITIONS)
    parents = {
        "ClienteID": (CUSTOMERS, t.customers()),
        "VendedorID": (SELLERS, t.sellers()),
        "ProdutoID": (PRODUCTS, t.price_history()),
        "CidadeID": (CITIES, t.cities()),
        "PaisID": (COUNTRIES, t.countries()),
        "CategoriaID": (CATEGORIES, t.categories()),
    }
    return quality_report(scan_table(t.spark, path), SALES, parents)


@query("layer_differences")
def layer_differences(t: Tables) -> DataFrame:
    """Sales as they arrived against a layer with rows lost, changed, doubled and made up."""
    arrived, sale = t.sales(), F.col("VendasID")
    kept = arrived.filter(sale % 101 != 3).withColumn(
        "Quantidade", F.when(sale % 97 == 5, F.col("Quantidade") + 1).otherwise(F.col("Quantidade")).cast("decimal(12,2)")
    )
    kept = kept.withColumn("Desconto", F.when(sale % 89 != 7, F.col("Desconto")))
    doubled, made_up = kept.filter(sale % 103 == 11), kept.filter(sale % 107 == 13).withColumn("VendasID", -sale)
    stored = new_folder(t.spark, SALES)
    overwrite(stack(kept, doubled, made_up), stored)
    return differences(arrived, scan_table(t.spark, stored), "VendasID")


@query("load_audit")
def load_audit_of_batches(t: Tables) -> DataFrame:
    mark = read_watermark(t.sales("vendas_1"))
    return load_audit(stack(*(t.sales(b).withColumn("lote", F.lit(b)) for b in NEW_BATCHES)), mark)


@query("sales_by_month")
def sales_by_month(t: Tables) -> DataFrame:
    return monthly(conform_sales(t.sales(), t.products()))
