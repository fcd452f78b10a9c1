"""Approximate nearest neighbours by inverted lists and an adaptive scan of dimensions.

Vectors are scaled to length one and turned by a random rotation, after which the first d of D dimensions
are an unbiased sample of a distance (Gao and Long, 2023). Lists are the cells of centroids fitted on a
bounded sample. Every query visits its nearest lists; within a list, candidates are held in blocks of
columns, and after each block a test on the partial distance abandons those that would, at the given
significance, not come among the nearest k. Survivors are ranked by the exact cosine of the original
vectors, ties by key, so equal vectors always rank by key.

Large lists and large groups of queries are cut by a hash, every part of a list meeting every part of its
queries, so that no task holds more than two parts. Every row is indexed. Vectors that are null, zero or hold null or
non-finite components, and rows without a key, take no part; vectors of another length than the query's
are no candidates. Rows that repeat a key are candidates each. Without candidates a query has no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respondry.llm.common import schema_with
from respondry.llm.vectors import matrix, sample, unit, usable
from respondry.sources.workspace import written


#: Rows met by all queries of a group at once.
STRIP = 512


@dataclass(frozen=True)
class Settings:
    """``most_lists`` bounds what is broadcast; ``visited`` is the share of lists that a query visits."""

    sample: int = 20_000
    most_lists: int = 1024
    visited: float = 0.7
    least_visited: int = 8
    columns: int = 16
    significance: float = 2.1
    list_part: int = 4096
    query_part: int = 512


@dataclass(frozen=True)
class Index:
    turn: np.ndarray
    centroids: np.ndarray


def fitted(rows: np.ndarray, width: int, lists: int, steps: int = 12, seed: int = 7) -> Index:
    """Random rotation, and Lloyd's iterations from a random choice of rows; empty cells keep their centroid."""
    random = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(random.normal(size=(width, width)))
    rows = rows @ turn
    lists = max(1, min(lists, len(rows)))
    centroids = rows[random.permutation(len(rows))[:lists]] if len(rows) else np.zeros((1, width))
    for _ in range(steps if len(rows) else 0):
        cell = nearest_lists(rows, centroids, 1)[:, 0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, cell, rows)
        n = np.bincount(cell, minlength=len(centroids))[:, None]
        centroids = np.where(n > 0, sums / np.maximum(n, 1), centroids)
    return Index(turn, centroids)


def nearest_lists(rows: np.ndarray, centroids: np.ndarray, count: int) -> np.ndarray:
    far = (centroids * centroids).sum(axis=1) - 2 * rows @ centroids.T
    return np.argsort(far, axis=1, kind="stable")[:, :count]


def survivors(
    blocks: list[np.ndarray], queries: list[np.ndarray], allowed, k: int, significance: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) that may be among a query's k nearest; squared distances by column blocks.

    All queries meet a strip of rows at once, a matrix product per block of columns. After each block a
    test on the distance so far abandons pairs, and rows that no query wants are left out of the next
    block. ``allowed(strip)`` says which pairs of a slice of rows count at all.
    """
    n, m = len(blocks[0]), len(queries[0])
    width = sum(block.shape[1] for block in blocks)
    query, row, far = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    bound, start, size = np.full(m, np.inf), 0, 64
    while start < n:
        strip = np.arange(start, min(start + size, n))
        alive, start, size = allowed(strip), start + size, min(2 * size, STRIP)
        partial, seen = np.zeros((len(strip), m)), 0
        for block, part in zip(blocks, queries):
            rows = block[strip]
            partial += (rows * rows).sum(axis=1)[:, None] + (part * part).sum(axis=1) - 2 * (rows @ part.T)
            seen += block.shape[1]
            # squared distances are at most 4, so 1e-12 leaves room for rounding
            alive &= partial * (width / seen) <= bound * (1 + significance / np.sqrt(seen) * (seen < width)) ** 2 + 1e-12
            wanted = alive.any(axis=1)
            if not wanted.all():
                strip, alive, partial = strip[wanted], alive[wanted], partial[wanted]
        i, j = np.nonzero(alive)
        query, row, far = np.concatenate([query, j]), np.concatenate([row, strip[i]]), np.concatenate([far, partial[i, j]])
        order = np.lexsort((far, query))
        query, row, far = query[order], row[order], far[order]
        last = np.flatnonzero(places(query) == k - 1)
        bound[query[last]] = far[last]
        near = far <= bound[query] + 1e-12
        query, row, far = query[near], row[near], far[near]
    return query, row


def places(group: np.ndarray) -> np.ndarray:
    """Number of each entry within its run of equal values."""
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    return np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times powers of two, which changes no cosine, so that no square over- or underflows."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def exact(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Cosines of pairs; every row is summed the same way wherever it stands."""
    rows, queries = scaled(rows), scaled(queries)
    return (rows * queries).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((queries * queries).sum(axis=1)))


NEAR = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])


def search(vectors: DataFrame, key: str, vector: str, asks: Column, k: int = 5, settings: Settings = Settings()) -> DataFrame:
    """Per query (rows where ``asks``) its k nearest: ``query_id``, ``rank``, ``key``, ``score``."""
    spark = vectors.sparkSession
    rows = vectors.where(usable(vector) & F.col(key).isNotNull())
    rows = rows.select(F.col(key).alias("id"), F.col(vector).alias("vector"), F.coalesce(asks, F.lit(False)).alias("asks"))
    rows = written(rows.withColumn("number", F.monotonically_increasing_id()), "searched")
    total, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = width or 1
    index = fitted(sample(rows, "number", "vector", settings.sample, width), width, min(isqrt(total), settings.most_lists))
    lists = len(index.centroids)
    visits = min(lists, max(settings.least_visited, ceil(settings.visited * lists)))
    shared = spark.sparkContext.broadcast(index)

    def place(batches):
        for batch in batches:
            turned = unit(matrix(batch["vector"], width)) @ shared.value.turn
            near = nearest_lists(turned, shared.value.centroids, visits)
            asks = batch["asks"].to_numpy(zero_copy_only=False)
            sizes = np.where(asks, visits, 0)
            starts = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            visited = pa.ListArray.from_arrays(starts, pa.array(near[asks].astype(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near[:, 0].astype(np.int32)), visited], names=[*batch.schema.names, "list", "visited"]
            )

    placed = written(rows.mapInArrow(place, schema_with(rows, "list int, visited array<int>")), "placed")
    queries = placed.where("asks").select("id", "vector", "number", F.explode("visited").alias("list"))
    # at most as many rows as there are lists
    list_parts = placed.groupBy("list").agg(F.ceil(F.count("*") / settings.list_part).cast("int").alias("list_parts"))
    query_parts = queries.groupBy("list").agg(F.ceil(F.count("*") / settings.query_part).cast("int").alias("query_parts"))
    parts = F.broadcast(list_parts.join(query_parts, "list"))

    def dealt(side: DataFrame, own: str, other: str, kind: int) -> DataFrame:
        side = side.select("id", "vector", "number", "list").join(parts, "list")
        side = side.withColumn(own, F.pmod(F.xxhash64("number"), F.col(f"{own}_parts")).cast("int"))
        side = side.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)))
        return side.withColumnsRenamed({own: "a", other: "b"} if kind == 0 else {other: "a", own: "b"}).select(
            "id", "vector", "number", "list", "a", "b", F.lit(kind).alias("kind")
        )

    parts = parts.withColumnsRenamed({"list_parts": "l_parts", "query_parts": "q_parts"})
    group = ["list", "a", "b"]
    met = dealt(placed, "l", "q", 0).union(dealt(queries, "q", "l", 1))
    met = met.repartition(*group).sortWithinPartitions(*group, "kind", "number")
    met = met.select("id", "vector", "number", "kind", F.xxhash64(*group).alias("group"))

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            numbers = table["group"].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist()]
            for a, b in zip(edges, edges[1:]):
                yield from scan(table.slice(a, b - a).combine_chunks())
            held = table.slice(edges[-1])
        if held is not None and len(held):
            yield from scan(held.combine_chunks())

    def scan(table):
        columns = {c: table[c].chunk(0) for c in table.column_names}
        kind, ids, numbers = (columns[c].to_numpy() for c in ("kind", "id", "number"))
        original = matrix(columns["vector"], width)
        sizes = np.diff(columns["vector"].offsets.to_numpy())
        turned = unit(original) @ shared.value.turn
        held, asking = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
        if not len(held) or not len(asking):
            return
        blocks, parts = (
            [np.ascontiguousarray(turned[side][:, c : c + settings.columns]) for c in range(0, width, settings.columns)]
            for side in (held, asking)
        )

        def allowed(strip):
            rows = held[strip][:, None]
            return (numbers[rows] != numbers[asking]) & (sizes[rows] == sizes[asking])

        query, near = survivors(blocks, parts, allowed, k, settings.significance)
        query, near = asking[query], held[near]
        scores = exact(original[near], original[query])
        order = np.lexsort((ids[near], -scores, query))
        order = order[places(query[order]) < k]
        query, near = query[order], near[order]
        yield pa.record_batch([numbers[query], ids[query], ids[near], scores[order]], schema=NEAR)

    found = met.mapInArrow(run, "query long, query_id long, id long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")
