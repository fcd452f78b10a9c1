"""Exact k nearest neighbours inside each class, as Spark jobs.

Rows are put into blocks that fit a task by a tree of axis splits grown on a sample. A row first
searches its own block, which bounds how far its k-th neighbour can be. Bounding boxes of the tree's nodes,
one inside the other, are walked from the root, and what lies in a box farther away than that is ruled
out; only the blocks that are left are visited. Inside a task the rows of
a block are split the same way into small cells, and cells are skipped by their boxes. Nothing is
approximated: rows are skipped only when they provably hold no neighbour. Axis splits suit vectors
with 0/1 entries: a box then fixes those entries, and each differing one adds to its distance.

Skew: equal vectors are reduced to their k + 1 smallest keys first (no other copy can be among
anyone's neighbours); splits follow the density of the distinct vectors; a block that is still too
large is cut by key hash; and the queries of a block are dealt to as many tasks as they need. A task
holds one block and one share of queries, whatever the data looks like.

Cost: rows times open cells. Where boxes rule nothing out (few rows spread over many dimensions)
an exact search is quadratic by nature. The shuffle grows with visited *blocks*, not with pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from respondry.functions.hashing import cut_point, hash_unit
from respondry.sources.workspace import written

ROWS_PER_CELL = 512
BLOCK_BYTES = 96 * 2**20
BLOCK_ROWS = 262_144
QUERY_BYTES = 64 * 2**20
QUERY_ROWS = 65_536
FEWEST_QUERIES = 1024
SAMPLE_BYTES = 64 * 2**20
SAMPLE_ROWS = 262_144
SAMPLE_PER_BLOCK = 64
SLICE_ENTRIES = 1_000_000
PAIR_ENTRIES = 1_000_000
SLACK = 1e-9
#: A vector held by more than this share of all rows is dealt to several parts.
HOT_SHARE = 1 / 1024


# --- trees of axis splits ------------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """Inner node ``i`` sends a row to ``left[i]`` if ``x[axis[i]] <= cut[i]``, else ``right[i]``.

    A child below zero is leaf ``-child - 1``.
    """

    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def leaves_of(self, rows: np.ndarray) -> np.ndarray:
        at = np.full(len(rows), 0 if len(self.axis) else -1)
        while True:
            inner = np.flatnonzero(at >= 0)
            if not len(inner):
                return -at - 1
            node = at[inner]
            goes_left = rows[inner, self.axis[node]] <= self.cut[node]
            at[inner] = np.where(goes_left, self.left[node], self.right[node])


def _halve(values: np.ndarray) -> float:
    """A cut between two distinct values that leaves the sides as equal as possible."""
    distinct, counts = np.unique(values, return_counts=True)
    below = np.cumsum(counts)[:-1]
    i = np.abs(below - len(values) / 2).argmin()
    return (distinct[i] + distinct[i + 1]) / 2


def _variance(rows: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Variance of each axis, a slice of rows at a time: no copy of a whole block is made."""
    step, base = max(1, PAIR_ENTRIES // rows.shape[1]), rows[members[0]]
    slices = [members[s:s + step] for s in range(0, len(members), step)]
    mean = sum((rows[some] - base).sum(0) for some in slices) / len(members)
    return sum(((rows[some] - base - mean) ** 2).sum(0) for some in slices) / len(members)


def grow_tree(rows: np.ndarray, leaf_rows: float) -> tuple[Tree, list[np.ndarray]]:
    """Split along the most varied axis until leaves hold ``leaf_rows``; also the leaves' rows."""
    axis, cut, children, leaves = [], [], [], []
    waiting = [(np.arange(len(rows)), None)]
    while waiting:
        members, parent = waiting.pop()
        spread = _variance(rows, members) if len(members) > max(1, leaf_rows) else np.zeros(1)
        if spread.max() > 0:
            number = len(axis)
            values = rows[members, spread.argmax()]
            axis.append(int(spread.argmax()))
            cut.append(_halve(values))
            children.append([0, 0])
            low = values <= cut[-1]
            waiting += [(members[low], (number, 0)), (members[~low], (number, 1))]
        else:
            number = -len(leaves) - 1
            leaves.append(members)
        if parent:
            children[parent[0]][parent[1]] = number
    sides = np.array(children, dtype=int).reshape(-1, 2)
    return Tree(np.array(axis, dtype=int), np.array(cut), sides[:, 0], sides[:, 1]), leaves


def _to_box(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every row to a box."""
    gap = np.maximum(np.maximum(low - rows, rows - high), 0.0)
    return np.einsum("ij,ij->i", gap, gap)


# --- inside a task -------------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """List column -> (rows, dimensions) matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _exact(queries: np.ndarray, data: np.ndarray, rows: np.ndarray, cols: np.ndarray):
    """Squared distances of the given pairs, entry by entry.

    The value depends on the two rows alone, not on how rows were grouped into tasks.
    """
    d2 = np.empty(len(rows))
    step = max(1, PAIR_ENTRIES // max(1, queries.shape[1]))
    for s in range(0, len(rows), step):
        gap = queries[rows[s:s + step]] - data[cols[s:s + step]]
        d2[s:s + step] = np.einsum("ij,ij->i", gap, gap)
    return d2


def _shortlist(queries: np.ndarray, data: np.ndarray, reach: np.ndarray, k: int):
    """Pairs that can be among the k best: within reach, and no worse than the k-th best here.

    ``closeness`` is ``q.x - |x|^2 / 2``, so a squared distance is ``|q|^2 - 2 * closeness``; it
    takes one matrix product and one comparison per pair.
    """
    ones = np.ones((len(queries), 1))
    squares = (data * data).sum(1)
    closeness = np.hstack([queries, ones]) @ np.hstack([data, squares[:, None] / -2]).T
    own = (queries * queries).sum(1)
    allowance = 4e-12 * float(own.max(initial=0.0) + squares.max(initial=0.0))
    near = closeness >= ((own - reach - allowance) / 2)[:, None]
    if len(data) > k and np.count_nonzero(near) > 4 * k * len(queries):
        kth = np.partition(closeness, len(data) - k, axis=1)[:, len(data) - k]
        near &= closeness >= (kth - allowance)[:, None]
    # ten times as fast as nonzero in two dimensions where few pairs are left
    return np.divmod(np.flatnonzero(near), len(data))


def _first_k(rows: np.ndarray, keys: np.ndarray, d2: np.ndarray, k: int):
    """The k best pairs of every query row, by distance, then key; with their places."""
    order = np.lexsort((keys, d2, rows))
    rows, keys, d2 = rows[order], keys[order], d2[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
    kept = place < k
    return rows[kept], place[kept], keys[kept], d2[kept]


class Best:
    """The k best pairs known so far per query, and the squared reach they leave."""

    def __init__(self, reach: np.ndarray, keys: np.ndarray, k: int):
        self.k, self.reach = k, reach.copy()
        self.d2 = np.full((len(reach), k), np.inf)
        self.keys = np.zeros((len(reach), k), dtype=keys.dtype)

    def meet(self, queries, asking, data, keys) -> None:
        """Let the asking queries see some rows."""
        step = max(1, SLICE_ENTRIES // len(data))
        for s in range(0, len(asking), step):
            some = asking[s:s + step]
            pair_rows, cols = _shortlist(queries[some], data, self.reach[some], self.k)
            if not len(pair_rows):
                continue
            fresh = _exact(queries[some], data, pair_rows, cols)
            touched = some[np.unique(pair_rows)]
            old_rows = np.repeat(touched, self.k)
            old_d2, old_keys = self.d2[touched].ravel(), self.keys[touched].ravel()
            known = np.isfinite(old_d2)
            rows, place, best_keys, d2 = _first_k(
                np.concatenate([old_rows[known], some[pair_rows]]),
                np.concatenate([old_keys[known], keys[cols]]),
                np.concatenate([old_d2[known], fresh]), self.k,
            )
            self.d2[rows, place], self.keys[rows, place] = d2, best_keys
            self.reach[touched] = np.minimum(self.reach[touched], self.d2[touched, -1])


def search_block(queries, reach, data, keys, k: int) -> Best:
    """The k best of a block for every query.

    ``reach`` is an upper bound on each query's squared k-th distance. Every query starts with the
    cell nearest to it and then sees only the cells its shrinking reach leaves open.
    """
    _, cells = grow_tree(data, ROWS_PER_CELL)
    bound = np.empty((len(queries), len(cells)))
    for c, members in enumerate(cells):
        bound[:, c] = _to_box(queries, data[members].min(0), data[members].max(0))
    first = bound.argmin(1)
    best = Best(reach, keys, k)
    for c, members in enumerate(cells):
        best.meet(queries, np.flatnonzero(first == c), data[members], keys[members])
    for c in np.argsort(bound.mean(0), kind="stable"):
        open_to = (bound[:, c] <= best.reach * (1 + SLACK) + SLACK) & (first != c)
        best.meet(queries, np.flatnonzero(open_to), data[cells[c]], keys[cells[c]])
    return best


# --- blocks --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Blocks:
    """The blocks of one class under a hierarchy of bounding boxes, one per node of the class tree.

    Node ``i`` below ``len(left)`` is inner, with its children in ``left`` and ``right``; the others are
    leaves, in order. An inner box holds the boxes below it, so a node that is too far away rules out
    everything below it. A leaf's rows lie in ``pieces`` blocks from number ``first`` on; an empty leaf
    has none, and a box that is nowhere.
    """

    left: np.ndarray
    right: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray
    first: np.ndarray
    pieces: np.ndarray

    @staticmethod
    def over(tree: Tree, leaves: dict) -> Blocks:
        """From ``{leaf: (rows, low, high, first, pieces)}``, the leaves numbered as the tree does."""
        inner = len(tree.axis)
        low = np.full((2 * inner + 1, len(next(iter(leaves.values()))[1])), np.inf)
        high, rows = -low, np.zeros(2 * inner + 1, np.int64)
        first, pieces = np.zeros((2, inner + 1), np.int64)
        for leaf, (count, bottom, top, number, parts) in leaves.items():
            rows[inner + leaf], low[inner + leaf], high[inner + leaf] = count, bottom, top
            first[leaf], pieces[leaf] = number, parts
        left, right = (np.where(side < 0, inner - side - 1, side) for side in (tree.left, tree.right))
        # children come after their parents
        for node in range(inner - 1, -1, -1):
            a, b = left[node], right[node]
            rows[node] = rows[a] + rows[b]
            low[node], high[node] = np.minimum(low[a], low[b]), np.maximum(high[a], high[b])
        return Blocks(left, right, low, high, rows, first, pieces)

    def _apart(self, points: np.ndarray, row: np.ndarray, node: np.ndarray, far: bool = False) -> np.ndarray:
        """Squared distance of each pair's row to its node's box, or to the box's far corner."""
        out = np.empty(len(row))
        step = max(1, PAIR_ENTRIES // points.shape[1])
        for s in range(0, len(row), step):
            some = slice(s, s + step)
            x, low, high = points[row[some]], self.low[node[some]], self.high[node[some]]
            gap = np.maximum(np.abs(x - low), np.abs(x - high)) if far else np.maximum(np.maximum(low - x, x - high), 0.0)
            out[some] = np.einsum("ij,ij->i", gap, gap)
        return out

    def surely(self, points: np.ndarray, k: int) -> np.ndarray:
        """A squared distance within which every point has ``k`` rows, infinite where the class has fewer.

        Each point goes down to the nearer child that holds ``k`` rows; the far corner of a box with
        so many rows is such a distance.
        """
        bound, everyone = np.full(len(points), np.inf), np.arange(len(points))
        node = np.zeros(len(points), np.int64)
        if self.rows[0] < k:
            return bound
        while True:
            bound[everyone] = np.minimum(bound[everyone], self._apart(points, everyone, node, far=True))
            inside = node < len(self.left)
            everyone, node = everyone[inside], node[inside]
            sides = [side[node] for side in (self.left, self.right)]
            apart = [np.where(self.rows[x] >= k, self._apart(points, everyone, x), np.inf) for x in sides]
            node = np.where(apart[0] <= apart[1], *sides)
            enough = np.minimum(*apart) < np.inf
            everyone, node = everyone[enough], node[enough]
            if not len(everyone):
                return bound

    def within(self, points: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, block) of the blocks whose box is no farther from a point than its limit.

        All points walk down together; a pair of point and node that is too far apart goes no further.
        """
        row = np.arange(len(points))
        node = np.zeros(len(points), np.int64)
        rows, leaves = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(row):
            near = self._apart(points, row, node) <= limit[row]
            row, node = row[near], node[near]
            leaf = node >= len(self.left)
            rows.append(row[leaf])
            leaves.append(node[leaf] - len(self.left))
            row, node = np.repeat(row[~leaf], 2), np.stack([self.left[node[~leaf]], self.right[node[~leaf]]], 1).ravel()
        row, leaf = np.concatenate(rows), np.concatenate(leaves)
        pieces = self.pieces[leaf]
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        return np.repeat(row, pieces), np.repeat(self.first[leaf], pieces) + number


def _block_rows(dimensions: int) -> int:
    """Rows per block. The row limit keeps short vectors from making thousands of cells a task."""
    return min(BLOCK_ROWS, max(1, BLOCK_BYTES // (8 * dimensions)))


def _most_queries(dimensions: int) -> int:
    """Queries per task. Fewer tasks per block mean fewer copies of the block in the shuffle."""
    return min(QUERY_ROWS, max(1, QUERY_BYTES // (8 * dimensions)))


def _share_rows(rows: int, dimensions: int, cores: int) -> int:
    """The most queries per task, or fewer when that would leave cores idle."""
    return min(_most_queries(dimensions), max(FEWEST_QUERIES, rows // cores))


def _grow_trees(points: DataFrame, cls: str, key: str, dimensions: int) -> dict:
    """``{class: (first leaf, tree)}``, grown on the distinct vectors of a key-hash sample."""
    sizes = {r[cls]: r["count"] for r in points.groupBy(cls).count().collect()}
    aim = _block_rows(dimensions) / 2
    most = min(SAMPLE_ROWS, max(1, SAMPLE_BYTES // (8 * dimensions)))
    chance, shares = F.lit(0), {}
    for value, rows in sizes.items():
        wanted = min(most, SAMPLE_PER_BLOCK * math.ceil(rows / aim))
        shares[value] = 0.0 if rows <= 2 * aim else min(1.0, wanted / rows)
        chance = F.when(F.col(cls) == value, cut_point(shares[value])).otherwise(chance)
    # the shares bound what is collected: SAMPLE_ROWS and SAMPLE_BYTES per class
    picked = points.filter(hash_unit(F.col(key), ":tree:") < chance).select(cls, "vec")
    sample = {value: [] for value in sorted(sizes)}
    for r in picked.collect():
        sample[r[cls]].append(r["vec"])
    trees, first = {}, 0
    for value, rows in sample.items():
        matrix = np.unique(np.array(rows).reshape(-1, dimensions), axis=0)
        tree, leaves = grow_tree(matrix, max(1.0, aim * shares[value]))
        trees[value] = (first, tree)
        first += len(leaves)
    return trees


def _assign_leaves(points: DataFrame, cls: str, trees: dict) -> DataFrame:
    """Add ``leaf``, the leaf of the row's class tree it falls into."""
    shared = points.sparkSession.sparkContext.broadcast(trees)
    schema = T.StructType([*points.schema.fields, T.StructField("leaf", T.IntegerType())])

    def assign(batches):
        for batch in batches:
            vectors = _matrix(batch.column("vec"))
            classes = np.array(batch.column(cls).to_pylist())
            leaf = np.zeros(len(classes), np.int32)
            for value in np.unique(classes).tolist():
                first, tree = shared.value[value]
                mine = classes == value
                leaf[mine] = first + tree.leaves_of(vectors[mine])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"]
            )

    return points.mapInArrow(assign, schema)


def _lay_out(boxes: list, trees: dict, dimensions: int, cores: int):
    """Blocks per class, and ``(leaf, first_block, pieces, shares)`` of every leaf with rows.

    ``boxes`` has one entry ``(leaf, rows, low, high)`` per leaf.
    """
    limit = _block_rows(dimensions)
    share_rows = _share_rows(sum(r["rows"] for r in boxes), dimensions, cores)
    firsts = sorted((first, value) for value, (first, _) in trees.items())
    starts = np.array([first for first, _ in firsts])
    table, leaves, block = [], {value: {} for value in trees}, 0
    for r in sorted(boxes, key=lambda r: r["leaf"]):
        first, value = firsts[np.searchsorted(starts, r["leaf"], side="right") - 1]
        pieces = -(-r["rows"] // limit)
        shares = max(1, -(-r["rows"] // (pieces * share_rows)))
        table.append((r["leaf"], block, pieces, shares))
        leaves[value][r["leaf"] - first] = (r["rows"], r["low"], r["high"], block, pieces)
        block += pieces
    return {value: Blocks.over(trees[value][1], found) for value, found in leaves.items() if found}, table


# --- Spark steps ---------------------------------------------------------------------------


def _search(queries: DataFrame, residents: DataFrame, key: str, k: int, carry: list[str]):
    """Every (block, share): its queries against its residents.

    Returns the ``carry`` columns of each query and ``near``, its k best, nearest first.
    """
    pair = T.StructType([
        T.StructField("d2", T.DoubleType()), T.StructField("key", residents.schema[key].dataType),
    ])
    schema = T.StructType(
        [*[queries.schema[c] for c in carry], T.StructField("near", T.ArrayType(pair))]
    )
    target = to_arrow_schema(schema)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return target.empty_table()
        best = search_block(
            _matrix(left.column("vec")), left.column("reach").to_numpy(),
            _matrix(right.column("vec")), right.column(key).to_numpy(), k,
        )
        found = np.isfinite(best.d2)
        offsets = np.concatenate([[0], np.cumsum(found.sum(1))]).astype(np.int32)
        pairs = pa.StructArray.from_arrays(
            [pa.array(best.d2[found]), pa.array(best.keys[found], right.schema.field(key).type)],
            ["d2", "key"],
        )
        near = pa.ListArray.from_arrays(pa.array(offsets), pairs)
        return pa.Table.from_arrays(
            [*[left.column(c) for c in carry], near], names=[*carry, "near"]
        ).cast(target)

    return (
        queries.groupBy("block", "share")
        .cogroup(residents.groupBy("block", "share"))
        .applyInArrow(meet, schema)
    )


def _add_targets(searched: DataFrame, cls: str, k: int, blocks: dict) -> DataFrame:
    """Add ``reach`` (squared bound on the k-th distance) and ``targets``, the blocks left open."""
    shared = searched.sparkSession.sparkContext.broadcast(blocks)
    schema = T.StructType([
        *searched.schema.fields, T.StructField("reach", T.DoubleType()),
        T.StructField("targets", T.ArrayType(T.IntegerType())),
    ])

    def add(batches):
        for batch in batches:
            vectors = _matrix(batch.column("vec"))
            classes = np.array(batch.column(cls).to_pylist())
            own = batch.column("block").to_numpy()
            near = batch.column("near")
            offsets = near.offsets.to_numpy()
            full = np.diff(offsets) >= k
            reach = np.full(batch.num_rows, np.inf)
            reach[full] = near.values.field("d2").to_numpy()[offsets[1:][full] - 1]
            places, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            for value in np.unique(classes).tolist():
                mine, there = np.flatnonzero(classes == value), shared.value[value]
                if there.pieces.sum() == 1:
                    continue
                rows, short = vectors[mine], ~full[mine]
                reach[mine[short]] = there.surely(rows[short], k)
                row, block = there.within(rows, reach[mine] * (1 + SLACK) + SLACK)
                other = block != own[mine][row]
                places.append(mine[row[other]])
                numbers.append(block[other].astype(np.int32))
            places, numbers = np.concatenate(places), np.concatenate(numbers)
            ends = np.cumsum(np.bincount(places, minlength=batch.num_rows))
            targets = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]), pa.int32()),
                pa.array(numbers[np.argsort(places, kind="stable")]),
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(reach), targets],
                names=[*batch.schema.names, "reach", "targets"],
            )

    return searched.mapInArrow(add, schema)


def _for_each_share(df: DataFrame, shares: DataFrame) -> DataFrame:
    """Residents once per share of the queries that visit their block."""
    numbers = F.sequence(F.lit(0), F.col("shares") - 1)
    dealt = df.join(F.broadcast(shares), "block").withColumn("share", F.explode(numbers))
    # fresh columns: the queries on the other side come from the same table
    return dealt.select(*[F.col(c).alias(c) for c in dealt.columns])


def _nearest_keys(points: DataFrame, cls: str, key: str, k: int) -> tuple[DataFrame, DataFrame]:
    """The rows searched, and for each of their distinct vectors ``(q, near)``, ``near`` of ``(d2, key)``."""
    spark, wanted = points.sparkSession, k + 1
    dimensions = points.select(F.size("vec").alias("d")).first()["d"]
    copies = Window.partitionBy(cls, "vec_hash", "vec").orderBy(key)
    trees = _grow_trees(points, cls, key, dimensions)
    limited = (
        points.select(cls, key, "vec", F.xxhash64("vec").alias("vec_hash"))
        .withColumn("copy_no", F.row_number().over(copies))
        .filter(F.col("copy_no") <= wanted)
    )
    candidates = written(_assign_leaves(limited, cls, trees), "candidates")
    # one row per leaf, and there are fewer leaves than sampled rows
    boxes = (
        candidates.select("leaf", F.posexplode("vec").alias("axis", "x"))
        .groupBy("leaf", "axis")
        .agg(F.count("*").alias("rows"), F.min("x").alias("low"), F.max("x").alias("high"))
        .groupBy("leaf")
        .agg(
            F.max("rows").alias("rows"),
            F.array_sort(F.collect_list(F.struct("axis", "low", "high"))).alias("sides"),
        )
        .select("leaf", "rows", F.col("sides.low").alias("low"), F.col("sides.high").alias("high"))
    )
    cores = spark.sparkContext.defaultParallelism
    blocks, table = _lay_out(boxes.collect(), trees, dimensions, cores)
    homes = spark.createDataFrame(table, "leaf int, first_block int, pieces int, shares int")
    homed = candidates.join(F.broadcast(homes), "leaf").withColumn(
        "block", (F.col("first_block") + F.pmod(F.xxhash64(key), "pieces")).cast("int")
    )
    residents = homed.select("block", key, "vec")
    queries = homed.filter("copy_no = 1").select(
        F.col(key).alias("q"), cls, "vec", "block",
        F.pmod(F.xxhash64(key), "shares").cast("int").alias("share"),
        F.lit(math.inf).alias("reach"),
    )
    own_shares = homes.select(
        F.explode(F.sequence("first_block", F.col("first_block") + F.col("pieces") - 1))
        .alias("block"), "shares",
    )
    searched = _search(
        queries, _for_each_share(residents, own_shares), key, wanted, ["q", cls, "vec", "block"]
    )
    asked = written(_add_targets(searched, cls, wanted, blocks), "queries")
    found = asked.select("q", "near")

    if any(there.pieces.sum() > 1 for there in blocks.values()):
        visits = asked.select("q", "vec", "reach", F.explode("targets").alias("block"))
        # one row per block
        shares = visits.groupBy("block").count().select(
            "block", F.ceil(F.col("count") / _most_queries(dimensions)).cast("int").alias("shares")
        )
        calls = visits.join(F.broadcast(shares), "block").withColumn(
            "share", F.pmod(F.xxhash64("q"), "shares").cast("int")
        )
        more = _search(calls, _for_each_share(residents, shares), key, wanted, ["q"])
        # a list that no visit can change is final
        parts = asked.filter(F.size("targets") > 0).select("q", "near").unionByName(more)
        merged = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, wanted)
        found = asked.filter(F.size("targets") == 0).select("q", "near").unionByName(
            parts.groupBy("q").agg(merged.alias("near"))
        )
    return candidates, found


def nearest_neighbours(points: DataFrame, cls: str, key: str, k: int) -> DataFrame:
    """For each distinct vector of a class, its ``k + 1`` nearest rows, one of them a copy of it.

    ``points`` has ``cls``, ``key`` (unique) and ``vec`` (array of double, one length), and is
    read several times, so pass a written table. Returns ``(cls, vec_hash, vec, near)`` with
    ``near`` = array of ``(d2, key, vec)`` ordered by distance, then key. A row finds its own
    ``k`` neighbours by dropping itself from the list of its vector.
    """
    candidates, found = _nearest_keys(points, cls, key, k)
    with_vectors = found.select("q", F.inline("near")).join(
        candidates.select(F.col(key).alias("key"), "vec"), "key"
    )
    # at most k + 1 rows per query
    lists = with_vectors.groupBy("q").agg(
        F.array_sort(F.collect_list(F.struct("d2", "key", "vec"))).alias("near")
    )
    distinct = candidates.filter("copy_no = 1")
    return distinct.join(lists, F.col(key) == F.col("q")).select(cls, "vec_hash", "vec", "near")


def nearest_keys(points: DataFrame, cls: str, key: str, k: int) -> DataFrame:
    """:func:`nearest_neighbours` with ``near`` = array of ``(d2, key)``: no neighbour's vector travels."""
    candidates, found = _nearest_keys(points, cls, key, k)
    distinct = candidates.filter("copy_no = 1")
    return distinct.join(found, F.col(key) == F.col("q")).select(cls, "vec_hash", "vec", "near")


def row_neighbours(points: DataFrame, cls: str, key: str, k: int, search=nearest_neighbours) -> DataFrame:
    """Add ``others``: the k nearest other rows of the same class, as ``(d2, key, vec)``, or as ``search`` has them.

    Rows meet their vector's list by a join. A vector that holds more than a share of
    :data:`HOT_SHARE` of all rows is dealt by key to several parts, each with a copy of its list.
    """
    lists = search(points, cls, key, k)
    same = [cls, "vec_hash"]
    points = points.withColumn("vec_hash", F.xxhash64("vec"))
    least = max(1, math.ceil(points.count() * HOT_SHARE))
    hot = points.groupBy(*same).agg(F.count("*").alias("copies")).filter(F.col("copies") > least)
    # fewer than 1 / HOT_SHARE rows
    hot = F.broadcast(hot.select(*same, F.ceil(F.col("copies") / least).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64(key, F.lit("part")), parts).cast("int")
    points = points.join(hot, same, "left").withColumn("part", part).drop("parts")
    lists = lists.join(hot, same, "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), parts - 1))
    ).drop("parts")
    columns = [c for c in points.columns if c not in ("vec_hash", "part")]
    return (
        points.join(lists, [*same, "vec", "part"])
        .withColumn("others", F.slice(F.filter("near", lambda n: n["key"] != F.col(key)), 1, k))
        .select(*columns, "others")
    )
