"""Potential segments from a scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv
from respondry.functions.scoring import potential_band


def segment_customers(
    scored: DataFrame, p_col: str = "p_yes", high: float = fv.HIGH_CUT, medium: float = fv.MEDIUM_CUT
) -> DataFrame:
    """Add ``potential_segment``; a row-wise expression, so filters on it stay in the JVM."""
    return scored.withColumn("potential_segment", potential_band(F.col(p_col), high, medium))


def segment_stats(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("potential_segment").count().orderBy("potential_segment")
