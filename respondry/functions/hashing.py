"""Key hashing: the source of every random-looking choice in the package.

A choice made from the row's own key does not change when partitions, executors or retries do,
and any SQL engine with ``md5`` can repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 2**32


def hash_unit(key: Column, salt: str | Column) -> Column:
    """32-bit integer (as bigint) from the first 8 hex digits of ``md5(key || salt)``.

    Use one salt per purpose: with a shared salt the low hashes that form the training split
    would also be the ones that form a sample.
    """
    salt = F.lit(salt) if isinstance(salt, str) else salt
    digest = F.md5(F.concat(key.cast("string"), salt).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def cut_point(fraction: float) -> int:
    """Hashes below this integer make up ``fraction`` of all keys."""
    return int(fraction * HASH_RANGE)
