"""Splits, folds and their sizes, decided by the key's hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv
from respondry.functions.hashing import HASH_RANGE, cut_point, hash_unit


def split_name(key: str, fractions=fv.SPLIT_FRACTIONS, seed: int = fv.SEED) -> Column:
    """Name of the split a key belongs to; the last split takes the remainder."""
    place = hash_unit(F.col(key), f":split:{seed}")
    reached, steps = 0.0, []
    for name, fraction in fractions[:-1]:
        reached += fraction
        steps.append(F.when(place < cut_point(reached), name))
    return F.coalesce(*steps, F.lit(fractions[-1][0]))


def assign_split(
    df: DataFrame, key: str = "contact_id", fractions=fv.SPLIT_FRACTIONS, seed: int = fv.SEED
) -> DataFrame:
    """Add ``split``. One table with a column, not three plans that each redo the input."""
    return df.withColumn("split", split_name(key, fractions, seed))


def random_split(df: DataFrame, fractions=fv.SPLIT_FRACTIONS, seed: int = fv.SEED):
    """Spark's own split; its rows change with the partitioning of the input."""
    return df.randomSplit([fraction for _, fraction in fractions], seed=seed)


def fold_number(key: Column, folds: int = fv.FOLDS, seed: int = fv.SEED) -> Column:
    place = hash_unit(key, f":fold:{seed}")
    return F.floor(place * folds / HASH_RANGE).cast("int")


def split_sizes(df: DataFrame) -> DataFrame:
    """Rows per split, original and synthetic apart."""
    return df.groupBy("split", "is_synthetic").count().orderBy("split", "is_synthetic")
