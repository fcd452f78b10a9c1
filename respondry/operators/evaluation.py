"""Classification metrics and exact ROC / precision-recall curves, computed on the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respondry.operators import cumulative
from respondry.sources.workspace import written


def outcome_counts(
    scored: DataFrame,
    by: list[str] | None = None,
    label: str = "label",
    score: str = "p_yes",
    prediction: str | None = None,
) -> DataFrame:
    """Positives and negatives per distinct score (and group): all any metric needs.

    Written once, so the scored table is scanned a single time for every metric and curve. Rows
    without a label or a score, NaN included, say nothing about the model and are left out.
    """
    known = F.col(label).isNotNull() & F.col(score).isNotNull()
    scored = scored.where(known & ~F.isnan(F.col(score).cast("double")))
    keys = [*(by or []), F.col(score).alias("score")]
    if prediction:
        keys.append(F.col(prediction).alias("prediction"))
    counts = scored.groupBy(*keys).agg(
        F.count_if(F.col(label) == 1.0).alias("pos"), F.count_if(F.col(label) == 0.0).alias("neg")
    )
    return written(counts, "outcome-counts")


def cumulative_counts(
    counts: DataFrame, by: list[str] | None = None, ranges: int | None = None
) -> DataFrame:
    """Counts in descending score order with running ``tp``/``fp`` and the totals ``p``/``n``."""
    by = list(by or [])
    if "prediction" in counts.columns:
        counts = counts.groupBy(*by, "score").agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
        )
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    points = cumulative.running_totals(
        counts, "score", ["pos", "neg"], by, descending=True, with_next=True, ranges=ranges
    ).withColumnsRenamed({"pos_total": "tp", "neg_total": "fp"})
    if by:
        return points.join(totals, by)
    row = totals.first()
    return points.withColumns({c: F.lit(row[c]).cast("long") for c in ("p", "n")})


def _share(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, null when the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def roc_curve(
    counts: DataFrame, by: list[str] | None = None, drop_intermediate: bool = True
) -> DataFrame:
    """``(threshold, fpr, tpr)`` from the highest threshold down, starting at (0, 0).

    The start has a null threshold (above every score). ``drop_intermediate`` leaves out the
    points on a straight line between their neighbours.
    """
    by = list(by or [])
    points = cumulative_counts(counts, by)
    if drop_intermediate:
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        last = F.col("pos_next").isNull()
        bend = (F.col("pos") != F.col("pos_next")) | (F.col("neg") != F.col("neg_next"))
        points = points.filter(first | last | bend)
    curve = points.select(
        *by,
        F.col("score").alias("threshold"),
        _share(F.col("fp"), F.col("n")).alias("fpr"),
        _share(F.col("tp"), F.col("p")).alias("tpr"),
    )
    start = counts.select(*by).distinct() if by else counts.sparkSession.range(1).select()
    start = start.select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return start.unionByName(curve).orderBy(*by, F.desc_nulls_first("threshold"))


def pr_curve(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``(threshold, precision, recall)`` by rising threshold, ending at recall 0, precision 1."""
    by = list(by or [])
    tp, fp = F.col("tp"), F.col("fp")
    curve = cumulative_counts(counts, by).select(
        *by,
        F.col("score").alias("threshold"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, F.col("p")).alias("recall"),
    )
    end = counts.select(*by).distinct() if by else counts.sparkSession.range(1).select()
    end = end.select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return curve.unionByName(end).orderBy(*by, F.asc_nulls_last("threshold"))


def curve_areas(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``roc_auc`` and ``pr_auc``: trapezoids under both curves in one aggregate.

    A point's predecessor is its own totals minus its own counts, so no second window is needed.
    """
    by = list(by or [])
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    tp0, fp0 = tp - pos, fp - neg
    precision = F.try_divide(tp, tp + fp)
    precision0 = F.coalesce(F.try_divide(tp0, tp0 + fp0), F.lit(1.0))
    p, n = F.max("p").cast("double"), F.max("n").cast("double")
    return cumulative_counts(counts, by).groupBy(*by).agg(
        F.try_divide(F.sum(neg * (tp + tp0) / 2), p * n).alias("roc_auc"),
        F.try_divide(F.sum(pos * (precision + precision0) / 2), p).alias("pr_auc"),
    )


def confusion(
    scored: DataFrame, by: list[str] | None = None, label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    scored = scored.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return scored.groupBy(
        *(by or []), F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).count()


def confusion_from_counts(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Confusion table out of :func:`outcome_counts` taken with a prediction column."""
    sides = F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("pos").alias("rows")),
        F.struct(F.lit(0.0).alias("label"), F.col("neg").alias("rows")),
    )
    return (
        counts.select(*(by or []), "prediction", F.inline(sides))
        .groupBy(*(by or []), "label", "prediction")
        .agg(F.sum("rows").alias("count"))
    )


def class_metrics(table: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy and weighted precision, recall, F1 from a confusion table (any class count)."""
    by = list(by or [])
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("count").alias("actual"),
                 F.lit(0).cast("bigint").alias("guessed"), hit.cast("bigint").alias("hits")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("actual"),
                 F.col("count").alias("guessed"), F.lit(0).cast("bigint").alias("hits")),
    )
    per_class = (
        table.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).cast("double").alias(c) for c in ("actual", "guessed", "hits")])
        .withColumn("precision", F.coalesce(F.try_divide("hits", "guessed"), F.lit(0.0)))
        .withColumn("recall", F.coalesce(F.try_divide("hits", "actual"), F.lit(0.0)))
        .withColumn(
            "f1",
            F.coalesce(
                F.try_divide(
                    2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
                ),
                F.lit(0.0),
            ),
        )
    )
    weight, rows = F.col("actual"), F.sum("actual")
    return per_class.groupBy(*by).agg(
        (F.sum("hits") / rows).alias("accuracy"),
        (F.sum(weight * F.col("precision")) / rows).alias("weighted_precision"),
        (F.sum(weight * F.col("recall")) / rows).alias("weighted_recall"),
        (F.sum(weight * F.col("f1")) / rows).alias("f1"),
    )


def evaluation_report(
    scored: DataFrame, by: str = "split", label: str = "label", score: str = "p_yes",
    prediction: str = "prediction",
) -> DataFrame:
    """Five metrics per split from one scan of the scored table."""
    counts = outcome_counts(scored, [by], label, score, prediction)
    metrics = class_metrics(confusion_from_counts(counts, [by]), [by])
    areas = curve_areas(counts, [by]).select(by, F.col("roc_auc").alias("auc"))
    return (
        areas.join(metrics, by)
        .select(by, "auc", "accuracy", "weighted_precision", "weighted_recall", "f1")
        .orderBy(by)
    )
