"""Aggregates behind the risk dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv
from respondry.operators.risk import score_ranks
from respondry.sources.workspace import written

LIST_COLUMNS = (
    "overall_risk_level", "churn_risk", "credit_risk", "composite_risk_score",
    "recommended_actions",
)


def top_at_risk(
    assessed: DataFrame, key: str = "contact_id", size: int = fv.PRIORITY_LIST_SIZE
) -> DataFrame:
    """Customers with rank <= ``size``; ties at the limit all stay.

    A stored rank column is filtered directly. Otherwise the rank table has one row per distinct score, so the filter runs on it and the customers are
    picked by a broadcast join. A huge tie at the top stays spread over all tasks. The list is
    written before it is sorted: sorting samples its input first, and would score everyone twice.
    """
    columns = [key, *LIST_COLUMNS, "risk_priority_rank"]
    if "risk_priority_rank" in assessed.columns:
        ranked = assessed.filter(F.col("risk_priority_rank") <= size)
        return ranked.select(columns).orderBy("risk_priority_rank", key)
    leading = score_ranks(assessed).filter(F.col("risk_priority_rank") <= size)
    listed = (
        assessed.select(key, *LIST_COLUMNS)
        .join(F.broadcast(leading), "composite_risk_score")
        .select(columns)
    )
    return written(listed, "top-at-risk").orderBy("risk_priority_rank", key)


def top_by_score(
    assessed: DataFrame, key: str = "contact_id", size: int = fv.PRIORITY_LIST_SIZE
) -> DataFrame:
    """The ``size`` highest scores, ties by key (a per-task top-k, then a merge)."""
    return (
        assessed.select(key, *LIST_COLUMNS)
        .orderBy(F.desc("composite_risk_score"), key)
        .limit(size)
    )


def score_profile(assessed: DataFrame, column: str = "composite_risk_score") -> DataFrame:
    return assessed.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )


def score_histogram(
    assessed: DataFrame,
    column: str = "composite_risk_score",
    bins=fv.SCORE_BINS,
    overflow: bool = False,
) -> DataFrame:
    """Rows per score bin, empty bins included; the last bin contains its upper edge.

    ``overflow=True`` adds a bin for scores above the last edge, which otherwise count nowhere.
    """
    score = F.col(column)
    members = []
    for number, (low, high) in enumerate(bins):
        below = score <= high if number == len(bins) - 1 else score < high
        members.append((f"{low}-{high}", (score >= low) & below))
    if overflow:
        members.append((f">{bins[-1][1]}", score > bins[-1][1]))
    counts = [F.count_if(inside).alias(name) for name, inside in members]
    rows = F.array(*[
        F.struct(F.lit(name).alias("bin"), F.col(f"`{name}`").alias("count"))
        for name, _ in members
    ])
    return assessed.agg(*counts).select(F.inline(rows))


def indicator_label(column: str) -> str:
    return column.replace("_score", "").replace("_", " ")


def risk_correlation(
    assessed: DataFrame, indicators=fv.RISK_INDICATORS, digits: int = 2
) -> DataFrame:
    """Pearson correlations of the indicator columns present, as ``(i, j, ..., value)``.

    A pair uses the rows where both values are known; a constant column correlates 0.0 with
    everything, itself included. Every row becomes one entry per pair of the upper triangle, and one
    aggregate by pair merges their counts, means and co-moments task by task; the rest is mirrored.
    So there is one pass and one formula, with nulls or without, and the plan stays as small as for
    one pair.
    """
    present = [c for c in indicators if c in assessed.columns]
    numbers = [F.col(c).cast("double") for c in present]
    pairs = [
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), x.alias("x"), y.alias("y"))
        for i, x in enumerate(numbers) for j, y in enumerate(numbers) if i <= j
    ]
    entries = assessed.select(F.inline(F.array(*pairs))) if pairs else assessed.sparkSession.createDataFrame([], "i int, j int, x double, y double")
    x, y = F.col("x"), F.col("y")
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    together = F.when(F.col("i") == F.col("j"), spread).otherwise(F.covar_pop(x, y))
    ratio = F.nanvl(together / F.nullif(spread, F.lit(0.0)), F.lit(0.0))
    known = entries.where(x.isNotNull() & y.isNotNull()).groupBy("i", "j").agg(
        F.round(F.coalesce(ratio, F.lit(0.0)), digits).alias("value")
    )
    found = {(r["i"], r["j"]): r["value"] for r in known.collect()}  # a row per pair of columns
    cells = [
        (i, j, indicator_label(a), indicator_label(b), found.get((min(i, j), max(i, j)), 0.0))
        for i, a in enumerate(present)
        for j, b in enumerate(present)
    ]
    return assessed.sparkSession.createDataFrame(
        cells, "i int, j int, indicator_i string, indicator_j string, value double"
    )
