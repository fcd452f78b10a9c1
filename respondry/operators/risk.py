"""Churn, credit and composite risk of segmented customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv
from respondry.functions.scoring import level_of, term_points, text_lookup, total
from respondry.operators.cumulative import running_totals
from respondry.operators.features import frequency_index, frequency_labels


def churn_points() -> Column:
    segment = F.col("potential_segment")
    by_segment = [
        F.when(segment == name, total(term_points(t) for t in terms))
        for name, terms in fv.CHURN_TERMS.items()
    ]
    return F.coalesce(*by_segment, F.lit(fv.CHURN_OTHER_SEGMENT))


def credit_points() -> Column:
    confidence = F.col("cons_conf_idx")
    base = F.coalesce(
        *[F.when(confidence < cut, points) for cut, points in fv.CREDIT_BASE],
        F.lit(fv.CREDIT_BASE_OTHERWISE),
    )
    flags = [F.when(F.col(c) == "yes", points).otherwise(0) for c, points in fv.CREDIT_FLAGS]
    return base + total(flags)


def outcome_labels(df: DataFrame) -> list[str]:
    """Outcomes by falling frequency, as the feature step numbers them; to be fitted on the whole table."""
    return frequency_labels(df, ["poutcome"])["poutcome"]


def add_outcome_index(df: DataFrame, labels: list[str] | None) -> DataFrame:
    """``poutcome_index`` by fitted labels; a table of the feature step has it already."""
    if "poutcome_index" in df.columns:
        return df
    if labels is None:
        raise ValueError("without poutcome_index, the fitted outcome labels are needed")
    return frequency_index(df, ["poutcome"], {"poutcome": labels})


def add_scores(segmented: DataFrame, labels: list[str] | None = None) -> DataFrame:
    return add_outcome_index(segmented, labels).withColumns(
        {"churn_risk_score": churn_points(), "credit_risk_score": credit_points()}
    )


def add_levels(df: DataFrame) -> DataFrame:
    churn, credit = F.col("churn_risk_score"), F.col("credit_risk_score")
    return df.withColumns({
        "churn_risk": level_of(churn, fv.CHURN_LEVELS),
        "churn_confidence": level_of(churn, fv.CHURN_CONFIDENCE),
        "credit_risk": level_of(credit, fv.CREDIT_LEVELS),
        "credit_confidence": level_of(credit, fv.CREDIT_CONFIDENCE),
    })


def add_composite(df: DataFrame) -> DataFrame:
    tenths = (
        F.col("churn_risk_score") * fv.CHURN_WEIGHT_TENTHS
        + F.col("credit_risk_score") * fv.CREDIT_WEIGHT_TENTHS
    )
    # a division may be null for the optimizer; saying it is not keeps joins on the composite from
    # pushing a null test, with all score expressions inside, below every projection
    composite = F.coalesce(tenths.cast("double") / 10, F.lit(0.0))
    return df.withColumns({
        "composite_risk_score": composite,
        "overall_risk_level": level_of(composite, fv.OVERALL_LEVELS),
    })


def add_actions(df: DataFrame) -> DataFrame:
    churn_high = F.col("churn_risk") == fv.CHURN_LEVELS[0][1]
    credit_high = F.col("credit_risk") == fv.CREDIT_LEVELS[0][1]
    both_medium = (F.col("churn_risk") == fv.CHURN_LEVELS[1][1]) & (
        F.col("credit_risk") == fv.CREDIT_LEVELS[1][1]
    )
    code = (
        F.when(churn_high & credit_high, "urgent")
        .when(churn_high, "high_priority")
        .when(credit_high, "attention")
        .when(both_medium, "moderate")
        .otherwise("routine")
    )
    return df.withColumn("action_code", code).withColumn(
        "recommended_actions", text_lookup(F.col("action_code"), fv.ACTION_TEXTS)
    )


def assess_risk(segmented: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """All row-wise risk columns; one projection over the segmented table, and no job.

    ``labels`` are the :func:`outcome_labels` of the whole table, so that a part of it scores as it
    does there.
    """
    return add_actions(add_composite(add_levels(add_scores(segmented, labels))))


def score_ranks(assessed: DataFrame, column: str = "composite_risk_score") -> DataFrame:
    """``(score, risk_priority_rank)`` for each distinct score, highest score first.

    A rank is one plus the number of rows with a greater score, so it follows from the row count
    per distinct score; no sort or window ever sees the rows themselves.
    """
    per_score = assessed.groupBy(column).agg(F.count("*").alias("rows"))
    return running_totals(per_score, column, ["rows"], descending=True, small=True).select(
        column, (F.col("rows_total") - F.col("rows") + 1).alias("risk_priority_rank")
    )


def rank_customers(assessed: DataFrame) -> DataFrame:
    """Add ``risk_priority_rank`` (ties share a rank, gaps follow).

    The composite takes at most one value per pair of churn and credit points, a few hundred by
    the point tables, so the rank table is safe to broadcast whatever the number of rows.
    """
    ranks = score_ranks(assessed)
    return assessed.join(F.broadcast(ranks), "composite_risk_score", "left")


def risk_summary(assessed: DataFrame) -> DataFrame:
    return (
        assessed.groupBy("overall_risk_level")
        .agg(
            F.count("*").alias("customer_count"),
            F.avg("churn_risk_score").alias("avg_churn_score"),
            F.avg("credit_risk_score").alias("avg_credit_score"),
            F.avg("composite_risk_score").alias("avg_composite_score"),
        )
        .orderBy("overall_risk_level")
    )


def risk_counts(assessed: DataFrame) -> DataFrame:
    levels = ["churn_risk", "credit_risk", "overall_risk_level"]
    return assessed.groupBy(*levels).count().orderBy(*levels)


def risk_marginals(assessed: DataFrame) -> DataFrame:
    """Counts per churn, credit and overall level as ``(dimension, level, count)``.

    The joint counts (at most 27 groups) are taken first; the three marginals sum those.
    """
    joint = assessed.groupBy("churn_risk", "credit_risk", "overall_risk_level").agg(
        F.count("*").alias("count")
    )
    sides = F.array(*[
        F.struct(F.lit(name).alias("dimension"), F.col(column).alias("level"))
        for name, column in (
            ("churn", "churn_risk"), ("credit", "credit_risk"), ("overall", "overall_risk_level"),
        )
    ])
    return (
        joint.select(F.inline(sides), "count")
        .groupBy("dimension", "level")
        .agg(F.sum("count").alias("count"))
        .orderBy("dimension", "level")
    )
