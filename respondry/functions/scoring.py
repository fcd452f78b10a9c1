"""Column expressions shared by several operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv


def potential_band(p: Column, high: float = fv.HIGH_CUT, medium: float = fv.MEDIUM_CUT) -> Column:
    """Potential segment of a probability; null and NaN count as low.

    The probability is named once per comparison: a filter on the segment is pushed down as this
    whole expression, with the probability's own expression in place of every mention.
    """
    known = F.nanvl(p, F.lit(float("-inf")))
    return (
        F.when(known > high, fv.HIGH_POTENTIAL)
        .when(known >= medium, fv.MEDIUM_POTENTIAL)
        .otherwise(fv.LOW_POTENTIAL)
    )


def level_of(score: Column, levels: Iterable[tuple[float | None, str]]) -> Column:
    """Name of the first level whose threshold the score reaches."""
    *steps, (_, last) = levels
    return F.coalesce(*[F.when(score >= cut, name) for cut, name in steps], F.lit(last))


def term_points(term: fv.Term) -> Column:
    column = F.col(term.column)
    hit = column > term.threshold if term.op == ">" else column < term.threshold
    return F.when(hit, term.points).otherwise(term.otherwise)


def total(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def text_lookup(key: Column, texts: Mapping[str, str]) -> Column:
    """Text for a key, null for a key without one."""
    return F.coalesce(*[F.when(key == k, text) for k, text in texts.items()])


def half_up_ratio(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` rounded half up with integer arithmetic; 0 for an empty whole."""
    scale = 10**digits
    doubled = F.greatest(whole, F.lit(1)) * 2
    return F.floor((part * (2 * scale) + whole) / doubled).cast("double") / scale
