"""Vectors as both vector operators read them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True where every component is there and finite and one is not zero; never null."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, zeros added up to ``width``."""
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width))
    if len(sizes) and sizes.min() == width == sizes.max():
        out[:] = values[offsets[0] : offsets[-1]].reshape(len(sizes), width)
    else:
        for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
            out[i, : b - a] = values[a:b]
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that no square over- or underflows."""
    rows = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True), np.finfo(float).tiny)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def sample(df: DataFrame, key: str, vector: str, rows: int, width: int) -> np.ndarray:
    """About ``rows`` unit vectors on the driver, chosen by a hash of the key and in its order."""
    total = df.count()
    if total > rows:
        df = df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * rows / total))
    table = df.select(F.col(key).alias("key"), F.col(vector).alias("vector")).toArrow().sort_by("key").combine_chunks()
    if not len(table):
        return np.zeros((0, width))
    return unit(matrix(table["vector"].chunk(0) if table["vector"].num_chunks else table["vector"], width))
