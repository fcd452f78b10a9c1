"""Missing-value handling and row filters.

The fill values are fitted on the whole input, before the range filter, and kept in a
:class:`CleaningModel` so that scoring uses the values learnt in training.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from respondry.spec import CONTACTS, TableSpec


def columns_of_type(df: DataFrame, kind: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def mark_missing(df: DataFrame, marker: str = CONTACTS.missing_marker) -> DataFrame:
    """Turn the missing marker into null in every string column."""
    strings = set(columns_of_type(df, T.StringType))
    return df.select(*[
        F.nullif(F.col(c), F.lit(marker)).alias(c) if c in strings else F.col(c)
        for c in df.columns
    ])


def mean_values(df: DataFrame, columns: list[str] | None = None) -> dict[str, float]:
    """Mean of every double column in one aggregate; NaN counts as missing."""
    columns = columns_of_type(df, T.DoubleType) if columns is None else columns
    if not columns:
        return {}
    row = df.agg(*[F.avg(F.nanvl(c, F.lit(None).cast("double"))).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns if row[c] is not None}


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, count)`` of the non-null values of several string columns, in one pass."""
    return (
        df.select(*columns)
        .unpivot([], columns, "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .count()
    )


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent non-null value per column; the smallest string wins a tie.

    Counting by value first keeps every task's share small, however frequent one value is.
    """
    first = F.min(F.struct((-F.col("count")).alias("order"), "value"))
    return (
        value_counts(df, columns)
        .groupBy("column")
        .agg(first.alias("first"))
        .select("column", F.col("first.value").alias("value"))
    )


def mode_values(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    columns = columns_of_type(df, T.StringType) if columns is None else columns
    # one row per column
    return {r["column"]: r["value"] for r in modes(df, columns).collect()} if columns else {}


def filter_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows with ``low <= column <= high``; a null is dropped."""
    return df.filter(F.col(column).between(low, high))


@dataclass(frozen=True)
class CleaningModel:
    """Fitted fill values and the fixed steps around them."""

    marker: str
    means: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    #: of numeric columns that training leaves as they are; only scoring fills these
    scoring_means: dict[str, float] = field(default_factory=dict)
    range_column: str | None = None
    range_limits: tuple[float, float] = (0, 0)
    dropped: tuple[str, ...] = ()

    @classmethod
    def fit(cls, df: DataFrame, spec: TableSpec = CONTACTS) -> CleaningModel:
        marked = mark_missing(df, spec.missing_marker).drop(spec.key, *spec.dropped)
        doubles = columns_of_type(marked, T.DoubleType)
        others = [c for c in spec.numeric if c in marked.columns and c not in doubles]
        means = mean_values(marked, doubles + others)
        return cls(
            marker=spec.missing_marker,
            means={c: v for c, v in means.items() if c in doubles},
            modes=mode_values(marked),
            scoring_means={c: v for c, v in means.items() if c in others},
            range_column=spec.range_column,
            range_limits=tuple(spec.range_limits),
            dropped=tuple(spec.dropped),
        )

    def fill(self, df: DataFrame) -> DataFrame:
        """Replace missing values in one projection."""

        def filled(name: str):
            if name in self.means:
                value = F.nanvl(F.col(name), F.lit(None).cast("double"))
                return F.coalesce(value, F.lit(self.means[name])).alias(name)
            if name in self.modes:
                return F.coalesce(F.col(name), F.lit(self.modes[name])).alias(name)
            return F.col(name)

        return df.select(*[filled(c) for c in df.columns])

    def transform(self, df: DataFrame, filter_rows: bool = True) -> DataFrame:
        """Marker to null, fill, range filter, column drop.

        Scoring passes ``filter_rows=False``: every customer who asks gets an answer, and a number
        missing in a column that training does not fill is taken as the column's rounded mean.
        """
        cleaned = self.fill(mark_missing(df, self.marker))
        if not filter_rows:
            cleaned = cleaned.withColumns({
                c: F.coalesce(c, F.round(F.lit(mean)).cast(cleaned.schema[c].dataType))
                for c, mean in self.scoring_means.items() if c in cleaned.columns
            })
        if filter_rows and self.range_column:
            cleaned = filter_range(cleaned, self.range_column, *self.range_limits)
        return cleaned.drop(*self.dropped)

    def save(self, spark: SparkSession, path: str) -> str:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "value string").coalesce(
            1
        ).write.mode("overwrite").text(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CleaningModel:
        values = json.loads(spark.read.text(path).first()["value"])
        values["range_limits"] = tuple(values["range_limits"])
        values["dropped"] = tuple(values["dropped"])
        return cls(**values)
