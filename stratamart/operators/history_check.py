"""Counting faults in the history of a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.functions.dates import open_end
from stratamart.model import ACTIVE, VALID_FROM, VALID_TO, Dimension
from stratamart.operators.shaping import stack

# Rules, in the order of the report.
RULES = ("sobreposicao", "lacuna", "dois_ativos", "intervalo_vazio", "fim_sem_sucessor", "sk_repetida", "sem_chave")


def marked_versions(dimension: DataFrame, spec: Dimension) -> DataFrame:
    """Key, surrogate key and bounds of every version, and which rules it breaks.

    Versions of a key are swept in the order of their starts against the latest end so far:

    * ``sobreposicao``: it starts before an earlier version has ended.
    * ``lacuna``: it starts after all earlier versions have ended.
    * ``dois_ativos``: it is active, and so is an earlier one.
    * ``intervalo_vazio``: it ends when it starts, or before, or lacks a bound.
    * ``fim_sem_sucessor``: it is active with an end, ended without one, or neither active nor ended.
    * ``sk_repetida``: another row has its surrogate key, or it has none.
    * ``sem_chave``: it has no natural key; such rows are judged by this rule and the last two alone.

    Empty versions end nothing and begin nothing, so they are left out of the sweep. The sweep sorts a key's versions, one per
    load that changed it; repeated surrogate keys are counted per key before they are joined back.
    """
    start, end, active = F.col(VALID_FROM), F.col(VALID_TO), F.coalesce(F.col(ACTIVE), F.lit(0)) == 1
    rows = dimension.select(spec.key, spec.sk, VALID_FROM, VALID_TO, ACTIVE)
    empty = ~F.coalesce(start < end, F.lit(False))
    rows = rows.withColumns({"intervalo_vazio": empty, "sem_chave": F.col(spec.key).isNull()})
    swept = Window.partitionBy(spec.key, "_in").orderBy(VALID_FROM, VALID_TO, spec.sk)
    before = swept.rowsBetween(Window.unboundedPreceding, -1)
    latest = F.max(VALID_TO).over(before)
    actives = F.sum(F.when(active, 1).otherwise(0)).over(Window.partitionBy(spec.key).orderBy(VALID_FROM, VALID_TO, spec.sk).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_in", ~F.col("intervalo_vazio") & ~F.col("sem_chave"))
    named = ~F.col("sem_chave")
    open_ended = F.coalesce(end == open_end(), F.lit(False))
    rows = rows.select(
        "*",
        (F.col("_in") & F.coalesce(start < latest, F.lit(False))).alias("sobreposicao"),
        (F.col("_in") & F.coalesce(start > latest, F.lit(False))).alias("lacuna"),
        (named & active & (F.coalesce(actives, F.lit(0)) > 0)).alias("dois_ativos"),
        (active != open_ended).alias("fim_sem_sucessor"),
    )
    times = dimension.groupBy(spec.sk).agg(F.count("*").alias("_times")).filter("_times > 1").withColumnRenamed(spec.sk, "_sk")
    joined = rows.join(times, F.col(spec.sk) == F.col("_sk"), "left")
    repeated = F.col(spec.sk).isNull() | F.col("_times").isNotNull()
    return joined.withColumn("sk_repetida", repeated).select(spec.key, spec.sk, VALID_FROM, VALID_TO, ACTIVE, *RULES)


def history_faults(dimension: DataFrame, spec: Dimension) -> DataFrame:
    """Per rule how many versions break it: tabela, regra, linhas."""
    counts = marked_versions(dimension, spec).agg(*(F.count_if(F.col(r)).alias(r) for r in RULES))
    pairs = F.array(*(F.struct(F.lit(r).alias("regra"), F.col(r).alias("linhas")) for r in RULES))
    return counts.select(F.lit(spec.table).alias("tabela"), F.inline(pairs))


def all_history_faults(dimensions: list[tuple[Dimension, DataFrame]]) -> DataFrame:
    return stack(*(history_faults(rows, spec) for spec, rows in dimensions))
