"""Per-customer decisions: typed input, validation, rules, recommendation text.

Everything is row-wise, so the same functions serve a table and a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from respondry.functions import fixed_values as fv
from respondry.functions.scoring import potential_band, text_lookup
from respondry.spec import CONTACTS, TableSpec, contact_type

HIGH_CHURN, MEDIUM_CHURN, LOW_CHURN = (name for _, name in fv.CHURN_LEVELS)
HIGH_CREDIT, MEDIUM_CREDIT, LOW_CREDIT = (name for _, name in fv.CREDIT_LEVELS)


def _listed(checks: list[tuple[str, Column]]) -> Column:
    """Names of the checks that are true."""
    return F.array_compact(F.array(*[F.when(condition, name) for name, condition in checks]))


def typed_input(raw: DataFrame, spec: TableSpec = CONTACTS) -> DataFrame:
    """Cast text columns to the contact schema.

    ``bad_columns`` lists the values that would not convert; such a row is flagged, not fatal.
    """
    columns = [*spec.categorical, *spec.numeric]
    present = [c for c in raw.columns if c in columns]

    def converted(c: str) -> Column:
        target = contact_type(c)
        return F.col(c) if isinstance(target, T.StringType) else F.col(c).try_cast(target)

    bad = [
        (c, F.col(c).isNotNull() & converted(c).isNull())
        for c in present
        if not isinstance(contact_type(c), T.StringType)
    ]
    rest = [c for c in raw.columns if c not in columns]
    return raw.select(
        *rest, *[converted(c).alias(c) for c in present], _listed(bad).alias("bad_columns")
    )


def validation_rules(spec: TableSpec = CONTACTS) -> tuple[list, list]:
    """``(errors, warnings)``: pairs of rule name and violation condition, nulls counted once."""
    errors, warnings = [], []
    for c in [*spec.categorical, *spec.numeric]:
        value = F.col(c)
        empty = value.isNull()
        if isinstance(contact_type(c), T.StringType):
            empty = empty | (value == "")
        errors.append((f"{c}:required", empty))
        if c in fv.ALLOWED_VALUES:
            errors.append((f"{c}:value", ~empty & ~value.isin(*fv.ALLOWED_VALUES[c])))
        if c in fv.HARD_LIMITS:
            errors.append((f"{c}:limit", ~value.between(*fv.HARD_LIMITS[c])))
        if c in fv.RECOMMENDED_LIMITS:
            warnings.append((f"{c}:recommended", ~value.between(*fv.RECOMMENDED_LIMITS[c])))
    return errors, warnings


def validate_input(df: DataFrame, spec: TableSpec = CONTACTS) -> DataFrame:
    """Add ``errors``, ``warnings`` (arrays of rule names) and ``is_valid``."""
    errors, warnings = validation_rules(spec)
    return df.withColumns({"errors": _listed(errors), "warnings": _listed(warnings)}).withColumn(
        "is_valid", F.size("errors") == 0
    )


def validation_summary(df: DataFrame, spec: TableSpec = CONTACTS) -> DataFrame:
    """Violations per rule in one scan, rules without any included."""
    errors, warnings = validation_rules(spec)
    rules = [(n, "error", c) for n, c in errors] + [(n, "warning", c) for n, c in warnings]
    counts = [F.count_if(c).alias(f"n{i}") for i, (_, _, c) in enumerate(rules)]
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("rule"), F.lit(kind).alias("kind"), F.col(f"n{i}").alias("violations")
        )
        for i, (name, kind, _) in enumerate(rules)
    ])
    return df.agg(*counts).select(F.inline(rows))


def rule_churn() -> Column:
    potential = F.col("potential")
    pdays, campaign, previous = F.col("pdays"), F.col("campaign"), F.col("previous")
    neglected = (pdays > fv.RULE_LOW_PDAYS) | (campaign > fv.RULE_LOW_CAMPAIGN)
    return (
        F.when(
            (potential == fv.LOW_POTENTIAL) & neglected & (previous < fv.RULE_LOW_PREVIOUS),
            HIGH_CHURN,
        )
        .when(
            (potential == fv.MEDIUM_POTENTIAL)
            & ((pdays > fv.RULE_MEDIUM_PDAYS) | (campaign > fv.RULE_MEDIUM_CAMPAIGN)),
            MEDIUM_CHURN,
        )
        .when((potential == fv.HIGH_POTENTIAL) & (pdays > fv.RULE_HIGH_PDAYS), MEDIUM_CHURN)
        .otherwise(LOW_CHURN)
    )


def rule_credit() -> Column:
    confidence = F.col("cons_conf_idx")
    between = (confidence >= fv.RULE_CONFIDENCE_HIGH) & (confidence < fv.RULE_CONFIDENCE_MEDIUM)
    borrows = (F.col("loan") == "yes") | (F.col("housing") == "yes")
    return (
        F.when((confidence < fv.RULE_CONFIDENCE_HIGH) | (F.col("default") == "yes"), HIGH_CREDIT)
        .when(between & borrows, MEDIUM_CREDIT)
        .otherwise(LOW_CREDIT)
    )


def recommendation() -> Column:
    nothing = F.lit("")
    return F.concat(
        text_lookup(F.col("potential"), fv.RECOMMENDATION_BASE),
        F.coalesce(text_lookup(F.col("churn_risk"), fv.RECOMMENDATION_CHURN), nothing),
        F.coalesce(text_lookup(F.col("credit_risk"), fv.RECOMMENDATION_CREDIT), nothing),
    )


def apply_rules(scored: DataFrame, p_col: str = "p_yes") -> DataFrame:
    """Add ``potential``, rule-based ``churn_risk`` and ``credit_risk``, and the text."""
    return (
        scored.withColumn("potential", potential_band(F.col(p_col)))
        .withColumns({"churn_risk": rule_churn(), "credit_risk": rule_credit()})
        .withColumn("marketing_recommendation", recommendation())
    )


def percentage(p: Column) -> Column:
    """A probability as percent with two decimals, the exact binary value rounded, ties to even.

    The product with 100 is kept as a sum of two doubles (Dekker), so that a value next to a tie falls
    on its own side. Null and NaN give null.
    """
    x = F.nullif(p.cast("double"), F.lit(float("nan"))) * 100
    big = x * float((1 << 27) + 1)
    high = big - (big - x)
    cents = x * 100
    rest = (high * 100 - cents) + (x - high) * 100
    whole = F.floor(cents).cast("double")
    over = (cents - whole - 0.5) + rest
    even = F.pmod(whole, F.lit(2.0)) == 0
    n = (whole + F.when((over > 0) | ((over == 0) & ~even), 1.0).otherwise(0.0)).cast("long")
    shown = F.concat(F.floor(n / 100).cast("string"), F.lit("."), F.lpad((n % 100).cast("string"), 2, "0"))
    return F.concat(shown, F.lit("%"))


def decide(scored: DataFrame, key: str = "contact_id", p_col: str = "p_yes") -> DataFrame:
    """One decision row per customer."""
    return apply_rules(scored, p_col).select(
        key,
        F.when(F.col("prediction") == 1.0, fv.WORD_YES).otherwise(fv.WORD_NO).alias("prediction"),
        percentage(F.col(p_col)).alias("probability"),
        "potential",
        "churn_risk",
        "credit_risk",
        "marketing_recommendation",
        F.struct(*fv.SUMMARY_COLUMNS).alias("customer_summary"),
    )
