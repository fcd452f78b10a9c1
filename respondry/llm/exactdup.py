"""Exact duplicates against a persistent index of text digests.

The index is a Parquet table in a folder, bucketed and sorted by the SHA-256 of the normalised text
(A-Z lower-cased, nothing else). Documents come in deliveries. A delivery is first reduced to one row
per digest, the row with the largest key; a sort-merge anti-join with the index leaves the digests it
does not know, and these are appended with the key that stays and the name of the delivery. What the
index knows is never rewritten, so a text stays with the delivery that brought it first. A delivery
that is added again under its name, after a crash say, appends nothing and gets the same answer.

Everything is DataFrame work. Digests are counted before they are shuffled, so a text that a third of
all rows share is no hot group; when rows meet their groups, digests held by more than one row in
:data:`HOT` of the delivery, at most so many, are broadcast, and all others are joined.

Null text counts as empty. A null key gives way to any other key. Rows that repeat a key and a text are
one group like any other: one of them, the first as read, stays. An empty delivery appends nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from respondry.sources.workspace import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A digest is hot if more than one row in so many has it.
HOT = 10_000


def digest(text: str) -> Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), 256))


def digests(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key``, ``digest`` and a number ``row`` per row, written: whole texts are read here and only here."""
    return written(docs.select(key, digest(text).alias("digest"), F.monotonically_increasing_id().alias("row")), "digests")


def groups(digested: DataFrame, key: str) -> DataFrame:
    """Per digest the key that stays (``keep_id``), its ``row`` and the ``group_size``."""
    # null sorts below any key; of equal keys the first row
    last = F.max(F.struct(F.col(key).alias("key"), (-F.col("row")).alias("back"))).alias("last")
    grouped = digested.groupBy("digest").agg(last, F.count("*").alias("group_size"))
    return grouped.select("digest", F.col("last.key").alias("keep_id"), (-F.col("last.back")).alias("keep_row"), "group_size")


def with_groups(digested: DataFrame, grouped: DataFrame, columns: list[str]) -> DataFrame:
    """Every row of ``digested`` with ``columns`` of its digest's row in the written table ``grouped``."""
    total = grouped.agg(F.sum("group_size")).first()[0] or 0
    hot = grouped.where((F.col("group_size") > 1) & (F.col("group_size") * HOT > total))
    hot = hot.select("digest", *columns, F.lit(True).alias("hot"))  # fewer than HOT rows
    marked = digested.join(F.broadcast(hot), "digest", "left")
    kept = [*digested.columns, *columns]
    rest = marked.where("hot IS NULL").select(*digested.columns).join(grouped.select("digest", *columns), "digest")
    return marked.where("hot").select(*kept).unionByName(rest.select(*kept))


@dataclass(frozen=True)
class DigestIndex:
    """The index in a folder, known to this session as the table ``name``."""

    spark: SparkSession
    name: str
    buckets: int

    @staticmethod
    def opened(spark: SparkSession, path: str, name: str, key_type: str = "bigint", buckets: int = 200) -> DigestIndex:
        """The index at ``path``, empty if there is none. ``buckets`` must be that of its first opening."""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id {key_type}, delivery STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return DigestIndex(spark, name, buckets)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, grouped: DataFrame, delivery: str) -> None:
        """Append what the index does not know of a delivery's groups."""
        known = self.table().select("digest").hint("merge")
        new = grouped.select("digest", "keep_id", F.lit(delivery).alias("delivery")).join(known, "digest", "left_anti")
        # a task per bucket, so that an append is a file per bucket
        new = new.repartition(self.buckets, "digest")
        new.write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def close(self) -> None:
        """Forget the table's name; the folder stays and can be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def deduplicated(index: DigestIndex, digested: DataFrame, key: str, delivery: str) -> DataFrame:
    """Add a delivery (see :func:`digests`) to the index and say of each of its rows what becomes of it.

    ``key``, ``digest``, ``keep_id`` (the key that stays, of whatever delivery), ``group_size`` (rows
    of this delivery with the text) and ``kept``.
    """
    grouped = written(groups(digested, key), "digest-groups")
    index.add(grouped, delivery)
    known = index.table().withColumnsRenamed({"keep_id": "held_id", "delivery": "held_by"})
    known = grouped.join(known.hint("merge"), "digest")
    here = F.col("held_by") == delivery
    resolved = known.select("digest", F.col("held_id").alias("keep_id"), F.when(here, F.col("keep_row")).alias("keep_row"), "group_size")
    rows = with_groups(digested, written(resolved, "resolved"), ["keep_id", "keep_row", "group_size"])
    kept = F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept")
    return rows.select(key, "digest", "keep_id", "group_size", kept)
