"""Column roles of a contact table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from respondry.functions import fixed_values as fv


@dataclass(frozen=True)
class TableSpec:
    """Which column plays which part; operators take one of these instead of fixed names."""

    key: str = "contact_id"
    categorical: tuple[str, ...] = fv.CATEGORICAL_COLUMNS
    numeric: tuple[str, ...] = fv.NUMERIC_COLUMNS
    label: str = fv.LABEL_COLUMN
    positive: str = fv.POSITIVE_LABEL
    dropped: tuple[str, ...] = fv.DROPPED_COLUMNS
    missing_marker: str = fv.MISSING_MARKER
    range_column: str = "age"
    range_limits: tuple[float, float] = fv.AGE_RANGE


CONTACTS = TableSpec()


def contact_type(column: str) -> T.DataType:
    if column in fv.INTEGER_COLUMNS:
        return T.IntegerType()
    if column in fv.MACRO_COLUMNS:
        return T.DoubleType()
    return T.StringType()


def contact_schema(key: str | None = None, columns=fv.CONTACT_COLUMNS) -> T.StructType:
    """Explicit contact schema, with an optional leading bigint key."""
    head = [T.StructField(key, T.LongType())] if key else []
    return T.StructType(head + [T.StructField(c, contact_type(c)) for c in columns])
