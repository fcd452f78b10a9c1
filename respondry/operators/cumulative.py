"""Running totals over a whole ordered table without a one-partition window.

Order values are dealt to ranges by Spark's range partitioning, and the table is written with the number
of its range. Sums run inside each range in parallel; the totals of the ranges, a row each, are summed
separately and added. Neither the number of ranges nor any expression grows with the rows of a range, no
value reaches the driver, and a table of any size goes the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from respondry.sources.workspace import written


def in_ranges(df: DataFrame, column: str, ranges: int | None = None) -> DataFrame:
    """``df``, written, with ``_range``: numbers that rise with ``column``; equal values share a range.

    The number of ranges is that of the shuffle partitions unless given. The table is written because
    the ranges come from a sample: afterwards a recomputed task finds them as they were.
    """
    dealt = df.repartitionByRange(ranges, column) if ranges else df.repartitionByRange(column)
    return written(dealt.withColumn("_range", F.spark_partition_id()), "ranges")


def running_totals(
    df: DataFrame,
    order_col: str,
    value_cols: list[str],
    partition_cols: list[str] | None = None,
    descending: bool = False,
    with_next: bool = False,
    ranges: int | None = None,
    small: bool = False,
) -> DataFrame:
    """Add ``<value>_total``: the inclusive running sum of each value in ``order_col`` order.

    ``df`` has one row per (partition, order value). ``with_next=True`` also adds ``<value>_next``, the
    value of the following row (null at the end). ``small=True`` promises a table of bounded size,
    which is summed in one task per partition.
    """
    groups = list(partition_cols or [])
    direction = F.desc if descending else F.asc
    ranged = df.withColumn("_range", F.lit(0)) if small else in_ranges(df, order_col, ranges)
    order = Window.partitionBy(*groups, "_range").orderBy(direction(order_col))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns = {f"{v}_total": F.sum(v).over(upto) for v in value_cols}
    if with_next:
        columns |= {f"{v}_next": F.lead(v).over(order) for v in value_cols}
    inside = ranged.withColumns(columns)
    if small:
        return inside.drop("_range")

    first_of = F.max_by if descending else F.min_by
    over_ranges = Window.partitionBy(*groups).orderBy(direction("_range"))
    earlier = over_ranges.rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*groups, "_range").agg(
        *[F.sum(v).alias(f"_{v}_sum") for v in value_cols],
        *[first_of(v, order_col).alias(f"_{v}_first") for v in value_cols],
    )
    offsets = totals.select(
        *groups,
        "_range",
        *[
            F.coalesce(F.sum(f"_{v}_sum").over(earlier), F.lit(0)).alias(f"_{v}_before")
            for v in value_cols
        ],
        *[F.lead(f"_{v}_first").over(over_ranges).alias(f"_{v}_after") for v in value_cols],
    )
    moved = {f"{v}_total": F.col(f"{v}_total") + F.col(f"_{v}_before") for v in value_cols}
    if with_next:
        moved |= {f"{v}_next": F.coalesce(f"{v}_next", f"_{v}_after") for v in value_cols}
    helpers = [f"_{v}_{side}" for v in value_cols for side in ("before", "after")]
    # one row per range, joined by its measured size
    return (
        inside.join(offsets, [*groups, "_range"])
        .withColumns(moved)
        .drop("_range", *helpers)
    )
