"""Campaign audiences and their expected conversions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv
from respondry.functions.hashing import cut_point, hash_unit
from respondry.functions.scoring import half_up_ratio


def sampled(
    key: str, fraction: float = fv.SAMPLE_FRACTION, seed: int = fv.SEED
) -> Column:
    """Sample without replacement decided by the key's hash."""
    return hash_unit(F.col(key), f":sample:{seed}") < cut_point(fraction)


def audience(
    strategy: str,
    key: str = "contact_id",
    fraction: float = fv.SAMPLE_FRACTION,
    seed: int = fv.SEED,
) -> Column:
    """Predicate that is true for the rows a strategy addresses."""
    segment = F.col("potential_segment")
    return {
        fv.STRATEGY_HIGH: segment == fv.HIGH_POTENTIAL,
        fv.STRATEGY_HIGH_MEDIUM: segment.isin(fv.HIGH_POTENTIAL, fv.MEDIUM_POTENTIAL),
        fv.STRATEGY_RANDOM: sampled(key, fraction, seed),
    }[strategy]


def select_audience(segmented: DataFrame, strategy: str, key: str = "contact_id") -> DataFrame:
    return segmented.filter(audience(strategy, key))


def compare_strategies(segmented: DataFrame, key: str = "contact_id") -> DataFrame:
    """One row per strategy, in the fixed order, from a single scan.

    A global aggregate always returns a row, so an empty audience still shows with zeros.
    """
    won = F.col("prediction") == 1.0
    counts = []
    for position, name in enumerate(fv.STRATEGIES):
        member = audience(name, key)
        counts += [
            F.count_if(member).alias(f"total_{position}"),
            F.count_if(member & won).alias(f"won_{position}"),
        ]
    lines = F.array(*[
        F.struct(
            F.lit(name).alias("Strategy"),
            F.col(f"total_{position}").alias("total"),
            F.col(f"won_{position}").alias("won"),
        )
        for position, name in enumerate(fv.STRATEGIES)
    ])
    return (
        segmented.agg(*counts)
        .select(F.inline(lines))
        .select(
            "Strategy",
            F.col("total").alias("Total Customers"),
            F.col("won").alias("Expected Conversions"),
            half_up_ratio(F.col("won"), F.col("total"), 4).alias("Conversion Rate"),
        )
    )
