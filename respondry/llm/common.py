"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, modulus: int, equal: int) -> Column:
    """True where crc32 of the key as text leaves that remainder; a null key leaves none."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % modulus == equal, F.lit(False))


def text_bytes(text: str) -> Column:
    """The text as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary").alias(text)


def words(text: bytes) -> list[bytes]:
    """Runs without white space (20, 09-0D), only A-Z lower-cased, as bytes do both."""
    return text.lower().split()


def sampled(df: DataFrame, rows: int, key: Column, count: int | None = None) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of ``key``: the same ones for any partitioning."""
    total = df.count() if count is None else count
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * rows / total))


def task_numbers() -> Iterator[int]:
    """Numbers that no other task of the stage hands out."""
    number = TaskContext.get().partitionId() << 40
    while True:
        yield number
        number += 1


def batches(columns: dict, schema: pa.Schema, rows: int = 65536) -> Iterator[pa.RecordBatch]:
    """Equally long columns as record batches of bounded length."""
    arrays = [pa.array(columns[f.name], f.type) for f in schema]
    for start in range(0, len(arrays[0]), rows):
        yield pa.record_batch([a.slice(start, rows) for a in arrays], schema=schema)


def schema_with(df: DataFrame, added: str) -> StructType:
    """The schema of ``df`` with more fields, given as DDL."""
    return StructType([*df.schema.fields, *StructType.fromDDL(added).fields])
