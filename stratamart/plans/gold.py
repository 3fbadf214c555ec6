"""Silver to gold: dimensions with surrogate keys and history, and the sales fact."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.dates import load_day
from stratamart.model import (
    ACTIVE,
    DIMENSIONS,
    FACT_DIMENSIONS,
    MONTH,
    SALES,
    SALES_PARTITION_TYPES,
    SALES_PARTITIONS,
    VALID_FROM,
    YEAR,
    Dimension,
    Lake,
)
from stratamart.operators.dimensions import first_load, merge_changes, require_extract
from stratamart.operators.history import differing_states, insert_states, last_of_day
from stratamart.operators.inferred import inferred_members, is_inferred, take_over
from stratamart.operators.keys import highest
from stratamart.operators.ledger import (
    LEDGER,
    compare_months,
    looked_up,
    month_digests,
    months_of_changed_lookups,
    table_digest,
)
from stratamart.operators.lookup import fitting, swap_keys_at_date
from stratamart.operators.months import differing_months, in_months
from stratamart.sinks.staged import finish_loads, forget_loads, stage, staging_of
from stratamart.sinks.tables import (
    overwrite,
    overwrite_partitioned,
    partition_path,
    recover,
    replace_partitions,
    switch,
)
from stratamart.sources.tables import scan_table, scan_table_if_present
from stratamart.workspace import exists, materialize, remove


def build(
    spark: SparkSession,
    lake: Lake,
    load_date: date | str | None = None,
    dimensions: Iterable[Dimension] = tuple(DIMENSIONS.values()),
    restart: bool = False,
) -> None:
    """Make the gold tables from silver, starting the dimensions' history on the load date.

    A dimension that exists is refused before anything is written, as its history and keys would be
    lost; ``restart`` replaces it all the same.
    """
    dimensions = tuple(dimensions)
    if not restart:
        for spec in dimensions:
            _refuse_existing(spark, lake, spec)
    for spec in dimensions:
        build_dimension(spark, lake, spec, load_date, restart)
    build_sales(spark, lake)


def build_dimension(
    spark: SparkSession,
    lake: Lake,
    spec: Dimension,
    load_date: date | str | None = None,
    restart: bool = False,
    remember: bool = False,
    apart: bool = False,
) -> None:
    """Start a dimension from its silver table; ``remember`` as for :func:`update_dimension`.

    With ``apart`` active and ended versions are stored apart, and updates write active ones and what they end alone.
    """
    if not restart:
        _refuse_existing(spark, lake, spec)
    rows = scan_table(spark, lake.table("silver", spec.table), lake.fmt)
    remove(spark, seen_path(lake, spec))
    if remember:
        load_date = _fixed_day(spark, load_date)
        _remember(spark, lake, spec, rows, load_date)
    path = lake.table("gold", spec.table)
    forget_loads(spark, path)
    if apart:
        overwrite_partitioned(first_load(rows, spec, load_date), path, [ACTIVE], lake.fmt)
    else:
        overwrite(first_load(rows, spec, load_date), path, lake.fmt)


def _refuse_existing(spark: SparkSession, lake: Lake, spec: Dimension) -> None:
    path = lake.table("gold", spec.table)
    recover(spark, path)
    if exists(spark, path):
        raise ValueError(f"{path} exists and holds history: update it, or build with restart=True")


def update_dimension(
    spark: SparkSession, lake: Lake, spec: Dimension, load_date: date | str | None = None, remember: bool = False
) -> None:
    """Merge the silver table into the dimension, keeping its history.

    With ``remember`` the keys of the extract are kept beside the dimension, by load date. A dimension whose
    loads were all remembered takes extracts in any order: one dated before the newest version is worked into the
    histories of the keys for which it says something else. Without that it is refused.

    The merged dimension is complete beside the current one before it takes its place. Of a dimension whose active and
    ended versions are stored apart, ended ones are not read, but for their surrogate keys, and not written again.
    """
    path = lake.table("gold", spec.table)
    dimension = _stored_dimension(spark, lake, spec)
    extract = scan_table(spark, lake.table("silver", spec.table), lake.fmt)
    filled = not dimension.filter(is_inferred(dimension, spec) & F.expr(_IS_ACTIVE)).isEmpty()
    if filled:
        require_extract(dimension, extract, spec)
        dimension = materialize(take_over(dimension, extract, spec), "taken-over")
    remembered = exists(spark, seen_path(lake, spec))
    if remembered and not remember:
        raise ValueError(f"{path} remembers its loads: one that is not remembered would end that")
    if not remembered or not remember:
        if remember:
            raise ValueError(f"{path} has loads that were not remembered")
        if not filled and _apart(spark, path):
            merged = merge_changes(dimension.filter(_IS_ACTIVE), extract, spec, load_date, highest(dimension, spec.sk))
            stage(merged, path, [ACTIVE], lake.fmt)
            finish_loads(spark, path, _ACTIVE_FOLDER)
        else:
            _replace(merge_changes(dimension, extract, spec, load_date), path, lake)
        return
    day = _fixed_day(spark, load_date)
    seen = scan_seen(spark, lake, spec)
    newest = seen.agg(F.max(VALID_FROM)).first()[0]
    if str(day) >= str(newest):
        merged = merge_changes(dimension, extract, spec, day)
    else:
        require_extract(dimension, extract, spec)
        merged = insert_states(dimension, differing_states(dimension, extract, spec, day), spec, seen)
    merged = materialize(merged, "merged")
    _remember(spark, lake, spec, extract, day)
    _replace(merged, path, lake)


def apply_changes(
    spark: SparkSession, lake: Lake, spec: Dimension, feed: DataFrame, at: str, order: str, remember: bool = False
) -> None:
    """Work a feed of changes into the dimension: several a key, in any order, dated by ``at`` and numbered by ``order``.

    Per key and day the last change counts, and equal consecutive values are one version. A dimension that remembers
    its loads keeps the days of the changes too, so that late ones find their place among them.
    """
    path = lake.table("gold", spec.table)
    dimension = _stored_dimension(spark, lake, spec)
    states = materialize(last_of_day(feed, spec, at, order), "states")
    remembered = exists(spark, seen_path(lake, spec))
    if remembered != remember:
        raise ValueError(f"{path} {'remembers' if remembered else 'does not remember'} its loads")
    seen = scan_seen(spark, lake, spec) if remember else None
    merged = materialize(insert_states(dimension, states, spec, seen), "merged")
    if remember:
        states.select(spec.key, VALID_FROM).write.mode("append").parquet(f"{seen_path(lake, spec)}/feed")
    _replace(merged, path, lake)


def infer_members(
    spark: SparkSession, lake: Lake, specs: Iterable[Dimension] = FACT_DIMENSIONS, load_date: date | str | None = None
) -> None:
    """Give every key that silver's sales use and a dimension lacks a member of its own, so that no fact stays without key.

    Their real rows take them over when they come: :func:`update_dimension` fills them in first, under the same key.
    """
    for spec in specs:
        path = lake.table("gold", spec.table)
        dimension = _stored_dimension(spark, lake, spec)
        members = materialize(inferred_members(dimension, _silver_sales(spark, lake), spec, load_date), "inferred")
        if not members.isEmpty():
            _replace(dimension.unionByName(members), path, lake)


def seen_path(lake: Lake, spec: Dimension) -> str:
    return f"{lake.table('gold', spec.table)}__vistos"


def scan_seen(spark: SparkSession, lake: Lake, spec: Dimension) -> DataFrame:
    """Key and day of every remembered load that had the key."""
    return spark.read.option("recursiveFileLookup", True).parquet(seen_path(lake, spec))


def _remember(spark: SparkSession, lake: Lake, spec: Dimension, extract: DataFrame, day: date | str) -> None:
    """Before the dimension changes, so that a load that breaks off and is repeated writes the same folder again."""
    keys = extract.select(spec.key, load_day(day).alias(VALID_FROM))
    keys.write.mode("overwrite").parquet(f"{seen_path(lake, spec)}/{day}")


def _fixed_day(spark: SparkSession, load_date: date | str | None) -> date | str:
    """Several queries follow; midnight must not fall between them."""
    return spark.range(1).select(F.current_date()).first()[0] if load_date is None else load_date


def build_sales(spark: SparkSession, lake: Lake) -> None:
    """Replace the fact; keys come from the stored dimensions, never from a second numbering.

    Silver is stored by the same months, so with broadcast dimensions nothing is shuffled.
    """
    dimensions = stored_dimensions(spark, lake)
    fits = fitting(dimensions)
    made_from = _made_from(spark, lake)
    overwrite_partitioned(
        swap_keys_at_date(_silver_sales(spark, lake), dimensions, fits=fits),
        lake.table("gold", SALES),
        SALES_PARTITIONS,
        lake.fmt,
        clustered=all(fits),
    )
    _write_ledger(spark, lake, made_from)


def refresh_sales(spark: SparkSession, lake: Lake) -> None:
    """Bring the fact's months up to what silver and the dimensions give now.

    The ledger beside the fact says from which files of silver each month was made, which files hold it, and
    which versions of the dimensions were looked up. Months are written again whose files differ, in silver or in
    the fact, and those with a sale that finds another version now; see :func:`months_to_refresh`. All others are
    neither read nor written. Months silver no longer has are removed. A refresh that did not come to its
    end has left months that the ledger does not know, so the next one catches up with it.

    Without a ledger, and for table formats whose files come and go by themselves, months are compared by content.
    """
    path = lake.table("gold", SALES)
    if lake.fmt == "parquet":
        finish_loads(spark, lake.table("silver", SALES))
    fact = scan_table_if_present(spark, path, lake.fmt)
    if fact is None:
        build_sales(spark, lake)
        return
    dimensions = stored_dimensions(spark, lake)
    fits = fitting(dimensions)
    sales = _silver_sales(spark, lake)
    made_from = _made_from(spark, lake)
    chosen = months_to_refresh(spark, lake)
    if chosen is None:
        months, gone = differing_months(swap_keys_at_date(sales, dimensions, fits=fits), fact)
    else:
        found = chosen.collect()
        months = [(r[YEAR], r[MONTH]) for r in found if r.guardado]
        gone = [(r[YEAR], r[MONTH]) for r in found if not r.guardado]
    if months:
        now = swap_keys_at_date(in_months(sales, months), dimensions, fits=fits)
        replace_partitions(now, path, SALES_PARTITIONS, lake.fmt, clustered=all(fits))
    for month in gone:
        remove(spark, partition_path(path, SALES_PARTITIONS, month))
    _write_ledger(spark, lake, made_from)


def months_to_refresh(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """Months that a refresh has to write or remove, and why; None where there is no ledger to tell.

    ``vendas_mudaram``: silver's files differ; ``fato_mudou``: the fact's own do; ``versoes_mudaram``: a sale finds another
    version of a dimension; ``guardado``: silver has the month, else it goes. A row per month at most.
    """
    ledger = _ledger(spark, lake)
    if ledger is None:
        return None
    silver, fact = (month_digests(spark, lake.table(layer, SALES)) for layer in ("silver", "gold"))
    months = compare_months(ledger, silver, fact).filter("guardado OR em_fato")
    used = _months_by_versions(spark, lake, ledger)
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"u.{c}")) for c in SALES_PARTITIONS]
    joined = months.alias("m").join(F.broadcast(used.withColumn("_used", F.lit(True))).alias("u"), same[0] & same[1], "left")
    by_version = F.coalesce("_used", F.lit(False)).alias("versoes_mudaram")
    return joined.select(*(f"m.{c}" for c in SALES_PARTITIONS), "guardado", "vendas_mudaram", "fato_mudou", by_version).filter(
        "vendas_mudaram OR fato_mudou OR versoes_mudaram OR NOT guardado"
    )


def _months_by_versions(spark: SparkSession, lake: Lake, ledger: DataFrame) -> DataFrame:
    """Months of sales that find another version than the ledger's image has; none while no dimension was loaded."""
    then = ledger.select("dimensoes").first()
    nothing = spark.createDataFrame([], "Ano int, Mes int")
    if then is None or then[0] == _dimension_digest(spark, lake):
        return nothing
    now = looked_up(stored_dimensions(spark, lake))
    before = scan_table(spark, _image_path(lake))
    return months_of_changed_lookups(_silver_sales(spark, lake), before, now, FACT_DIMENSIONS)


def _silver_sales(spark: SparkSession, lake: Lake) -> DataFrame:
    return scan_table(spark, lake.table("silver", SALES), lake.fmt, SALES_PARTITION_TYPES)


def _ledger_path(lake: Lake) -> str:
    return f"{lake.table('gold', SALES)}__ledger"


def _image_path(lake: Lake) -> str:
    return f"{lake.table('gold', SALES)}__versoes"


def _ledger(spark: SparkSession, lake: Lake) -> DataFrame | None:
    if lake.fmt != "parquet":
        return None
    for path in (_ledger_path(lake), _image_path(lake)):
        recover(spark, path)
        if not exists(spark, path):
            return None
    return spark.read.schema(LEDGER).parquet(_ledger_path(lake))


def _dimension_digest(spark: SparkSession, lake: Lake) -> str:
    return table_digest(spark, [lake.table("gold", spec.table) for spec in FACT_DIMENSIONS])


def _made_from(spark: SparkSession, lake: Lake) -> dict[tuple, str] | None:
    """Digests of silver's months, taken before they are read: what comes in meanwhile is seen by the next refresh."""
    if lake.fmt != "parquet":
        return None
    return _by_month(month_digests(spark, lake.table("silver", SALES)))


def _by_month(digests: DataFrame) -> dict[tuple, str]:
    return {(r[YEAR], r[MONTH]): r.digest for r in digests.collect()}


def _write_ledger(spark: SparkSession, lake: Lake, made_from: dict[tuple, str] | None) -> None:
    """The image first: a ledger that is older than its image names months that are then written again."""
    if made_from is None:
        return
    dimensions = _dimension_digest(spark, lake)
    ledger = _ledger(spark, lake)
    held = None if ledger is None else ledger.select("dimensoes").first()
    if held is None or held[0] != dimensions:
        switch(looked_up(stored_dimensions(spark, lake)), _image_path(lake))
    fact = _by_month(month_digests(spark, lake.table("gold", SALES)))
    rows = [(*month, made_from.get(month), digest, dimensions) for month, digest in fact.items()]
    switch(spark.createDataFrame(rows, LEDGER).coalesce(1), _ledger_path(lake))


def stored_dimensions(
    spark: SparkSession, lake: Lake, specs: Iterable[Dimension] = FACT_DIMENSIONS
) -> list[tuple[Dimension, DataFrame]]:
    return [(spec, _stored_dimension(spark, lake, spec)) for spec in specs]


_IS_ACTIVE = f"{ACTIVE} <=> 1"
_ACTIVE_FOLDER = (f"{ACTIVE}=1",)


def _apart(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/{_ACTIVE_FOLDER[0]}")


def _stored_dimension(spark: SparkSession, lake: Lake, spec: Dimension) -> DataFrame:
    """A gold dimension, after an update of it that broke off is finished."""
    path = lake.table("gold", spec.table)
    recover(spark, path)
    if exists(spark, staging_of(path)):
        finish_loads(spark, path, _ACTIVE_FOLDER)
    return scan_table(spark, path, lake.fmt)


def _replace(merged: DataFrame, path: str, lake: Lake) -> None:
    """Put a whole dimension in the place of the stored one, stored as that is."""
    switch(merged, path, lake.fmt, [ACTIVE] if _apart(merged.sparkSession, path) else [])
