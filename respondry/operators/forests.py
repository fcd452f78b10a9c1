"""Random forests over two classes, grown level by level on binned rows.

The method is that of ``pyspark.ml``'s classifier: slots cut into at most 32 bins, a Poisson count for every
row and tree, ``ceil(sqrt(slots))`` slots drawn per node, the split of the greatest Gini gain, and twin leaves
of one prediction joined in the end. What differs is the order of the work. There the counts of all trees are
touched row by row, so nearly every addition misses the processor's cache; here a task takes a block of rows
through one tree after another. Rows are binned once, a byte per slot.

A level is one Spark job: tasks count their blocks per (tree, nodes), the counts are added up by a grouping,
and each group picks its splits. Only the trees reach the driver. A row's node is found again from the root on
every level, so there is no state between jobs that a lost executor could take along.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respondry.sources.models import load_forest
from respondry.sources.workspace import new_path, remove

MAX_BINS = 32
#: Rows looked at for the cuts of the bins.
SAMPLE_ROWS = max(10_000, MAX_BINS**2)
BLOCK_ROWS = 2**15
BLOCK_BYTES = 4 * 2**20
#: Nodes of a tree that are counted and searched as one.
UNIT_NODES = 512
#: Counts a task holds at a time; a level of more takes several jobs.
COUNT_BYTES = 256 * 2**20


# --- bins ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bins:
    """``cuts`` of every slot, None where it is a category of two values; ``sizes`` has the bins of each."""

    cuts: list
    sizes: np.ndarray

    @property
    def width(self) -> int:
        """Bins of the widest slot, or two."""
        return max(2, int(self.sizes.max()))

    def number(self, rows: np.ndarray) -> np.ndarray:
        """Bins of the entries. A value is in the first bin whose cut it does not exceed."""
        out = np.empty(rows.shape, np.uint8)
        for slot, cuts in enumerate(self.cuts):
            values = rows[:, slot]
            if cuts is None:
                if ((values < 0) | (values >= 2)).any():
                    raise ValueError(f"slot {slot} is a category of two values and holds others")
                out[:, slot] = np.nan_to_num(values)
            else:
                out[:, slot] = np.searchsorted(cuts, np.ascontiguousarray(values))
        return out


def find_cuts(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` cuts between neighbouring distinct values, with alike numbers of values between them."""
    distinct, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) <= most:
        return middles
    stride = counts.sum() / (most + 1)
    cuts, target, below = [], stride, np.cumsum(counts)
    for i in range(1, len(distinct)):
        if abs(below[i - 1] - target) < abs(below[i] - target):
            cuts.append(middles[i - 1])
            target += stride
    return np.array(cuts[:most])


def _two_valued(train: DataFrame) -> set | None:
    """Slots that are categories of two values; None if any has more."""
    attributes = train.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    if any(len(a.get("vals", [])) != 2 for a in attributes.get("nominal", [])):
        return None
    return {a["idx"] for kind in ("binary", "nominal") for a in attributes.get(kind, [])}


def _fit_bins(train: DataFrame, rows: int, seed: int, categories: set) -> Bins:
    sample = train.select("features")
    if rows > SAMPLE_ROWS:
        sample = sample.sample(fraction=SAMPLE_ROWS / rows, seed=seed)
    # SAMPLE_ROWS rows or about so many
    values = np.array([r["features"].toArray() for r in sample.collect()])
    most = min(MAX_BINS, rows) - 1
    cuts = [None if slot in categories else find_cuts(values[:, slot], most) for slot in range(values.shape[1])]
    return Bins(cuts, np.array([2 if c is None else len(c) + 1 for c in cuts]))


def _binned(train: DataFrame, bins: Bins) -> DataFrame:
    """``(block, cells)``: blocks of rows, a byte ``2 * bin + label`` per slot."""
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // len(bins.sizes)))

    def pack(batches):
        part, number, held, count = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            rows = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            label = batch.column("label").to_numpy().astype(np.uint8)
            held.append(2 * bins.number(rows) + label[:, None])
            count += batch.num_rows
            if count >= most:
                cells, held, count = np.concatenate(held), [], 0
                for s in range(0, len(cells), most):
                    yield block(part, number, cells[s:s + most])
                    number += 1
        if count:
            yield block(part, number, np.concatenate(held))

    def block(part, number, cells):
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + number]), pa.array([cells.tobytes()], pa.binary())], names=["block", "cells"]
        )

    return train.select(vector_to_array("features").alias("vec"), "label").mapInArrow(pack, "block long, cells binary")


# --- trees ---------------------------------------------------------------------------------


def _gini(stats: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return 1 - (stats * stats).sum(-1) / np.maximum(rows, 1) ** 2


class Growing:
    """One tree: arrays of the nodes of each level, and which of them the next job has to look at."""

    def __init__(self, number: int, seed: int):
        self.number, self.seed = number, seed
        self.levels = [self._nodes(np.zeros((1, 2)))]
        self.open = [np.zeros(1, int)]
        self.steps = []

    @staticmethod
    def _nodes(stats: np.ndarray) -> dict:
        n = len(stats)
        return {
            "stats": stats, "slot": np.full(n, -1), "bin": np.zeros(n, int), "gain": np.full(n, -1.0),
            "flip": np.zeros(n, bool), "child": np.full(n, -1),
        }

    def draw(self, slots: int, each: int) -> np.ndarray:
        """Slots (``each``, nodes) of the open nodes."""
        rng = np.random.default_rng([self.seed, self.number, len(self.steps)])
        chance = rng.random((len(self.open[-1]), slots))
        return np.sort(np.argsort(chance, axis=1)[:, :each], axis=1).T.copy()

    def grow(self, found: np.ndarray, bins: Bins, max_depth: int) -> None:
        """Take the splits of the open nodes, ``slot, bin, gain, flip`` and the rows per class left and right."""
        nodes, asked = self.levels[-1], self.open[-1]
        if len(self.levels) == 1:
            nodes["stats"][asked] = found[:, 4:6] + found[:, 6:8]
        cut = found[:, 2] > 0
        at, splits = asked[cut], found[cut]
        nodes["slot"][at], nodes["bin"][at], nodes["gain"][at] = splits[:, 0], splits[:, 1], splits[:, 2]
        nodes["flip"][at], nodes["child"][at] = splits[:, 3] > 0, 2 * np.arange(len(at))
        below = self._nodes(splits[:, 4:8].reshape(-1, 2))
        mixed = (below["stats"] > 0).all(1) & (len(self.levels) < max_depth)
        number = np.full(len(mixed) + 1, -1)
        number[:-1][mixed] = np.arange(mixed.sum())
        child = nodes["child"][asked]
        left, right = (np.where(child < 0, -1, number[np.where(child < 0, -1, child + side)]) for side in (0, 1))
        # bins that go left; a node without a split sends its rows nowhere
        place, width = np.arange(bins.width), nodes["bin"][asked][:, None]
        category = np.array([c is None for c in bins.cuts])[nodes["slot"][asked]][:, None]
        goes = np.where(category, place == width, place <= width)
        self.steps.append((np.maximum(nodes["slot"][asked], 0), goes, left, right))
        self.levels.append(below)
        self.open.append(np.flatnonzero(mixed))

    def pruned(self, bins: Bins, max_depth: int) -> dict:
        """Columns of the nodes of the tree cut at ``max_depth``, numbered as a walk meets them.

        Twin leaves of one prediction are joined.
        """
        levels = [{**nodes, **{c: nodes[c].copy() for c in ("child", "slot", "gain")}} for nodes in self.levels[:max_depth + 1]]
        if len(levels) > max_depth:
            levels[-1] |= {c: np.full_like(levels[-1][c], -1) for c in ("child", "slot", "gain")}
        sizes = []
        for depth in range(len(levels) - 1, -1, -1):
            nodes = levels[depth]
            inner = np.flatnonzero(nodes["child"] >= 0)
            size = np.ones(len(nodes["child"]), int)
            if len(inner):
                below, first = levels[depth + 1], nodes["child"][inner]
                said = below["stats"].argmax(1)
                twins = (below["child"][first] < 0) & (below["child"][first + 1] < 0) & (said[first] == said[first + 1])
                gone, kept = inner[twins], inner[~twins]
                nodes["child"][gone], nodes["slot"][gone], nodes["gain"][gone] = -1, -1, -1.0
                first = nodes["child"][kept]
                size[kept] += sizes[-1][first] + sizes[-1][first + 1]
            sizes.append(size)
        sizes.reverse()
        out, values, at, number = [], [], np.zeros(1, int), np.zeros(1, int)
        for depth, nodes in enumerate(levels):
            child = nodes["child"][at]
            inner = child >= 0
            left, right = np.full(len(at), -1), np.full(len(at), -1)
            left[inner] = number[inner] + 1
            right[inner] = left[inner] + sizes[depth + 1][child[inner]] if inner.any() else 0
            slot, width = nodes["slot"][at], nodes["bin"][at]
            values += [
                [] if s < 0 else [float(b)] if bins.cuts[s] is None else [float(bins.cuts[s][b])]
                for s, b in zip(slot, width)
            ]
            categories = np.array([2 if s >= 0 and bins.cuts[s] is None else -1 for s in slot], int)
            out.append((number, nodes["stats"][at], nodes["gain"][at], left, right, slot, categories))
            at = np.stack([child[inner], child[inner] + 1], 1).ravel()
            number = np.stack([left[inner], right[inner]], 1).ravel()
            if not len(at):
                break
        names = ("number", "stats", "gain", "left", "right", "slot", "categories")
        return {"value": values, **{name: np.concatenate(parts) for name, parts in zip(names, zip(*out))}}


# --- a level -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Unit:
    """Open nodes of a tree from ``first`` on, with the slots (drawn, nodes) of each.

    Their counts lie in one row of numbers, slot by slot, node by node, bin by bin, class by class;
    ``start`` has the place of each node within its slot's part, ``ends`` the ends of the parts. A unit is
    ``whole`` if the tree has no other open nodes.
    """

    tree: int
    first: int
    whole: bool
    slots: np.ndarray
    start: np.ndarray
    ends: np.ndarray

    @staticmethod
    def of(tree: int, first: int, whole: bool, slots: np.ndarray, sizes: np.ndarray) -> Unit:
        cells = 2 * sizes[slots]
        reached = np.cumsum(cells, 1)
        return Unit(tree, first, whole, slots, reached - cells, np.cumsum(reached[:, -1]))


def _poisson_table() -> np.ndarray:
    """Poisson counts of mean 1 by 16 random bits."""
    reached = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(12)])
    return np.searchsorted(reached, (np.arange(2**16) + 0.5) / 2**16).astype(np.uint8)


def _expanded(step: tuple, last: int) -> tuple:
    """Slot of each node, and its child by ``2 * bin + label``; the child ``last`` ends the walk."""
    slot, goes, left, right = step
    child = np.where(goes, left[:, None], right[:, None])
    return slot, np.repeat(np.where(child < 0, last, child), 2, axis=1).ravel(), bool((child < 0).any())


def _count(cells: np.ndarray, block: int, slots: int, seed: int, table: np.ndarray, walks: dict, units: dict, counts: dict):
    """Add a block's rows to the counts of every unit."""
    rows = len(cells) // slots
    for tree, (steps, width) in walks.items():
        drawn = np.random.Generator(np.random.SFC64([seed, tree, block >> 32, block & (2**32 - 1)]))
        weight = table.take(drawn.integers(0, 2**16, rows, np.uint16))
        taken = np.flatnonzero(weight)
        weight, base, node = weight[taken].astype(np.float64), taken * slots, np.zeros(len(taken), int)
        for slot, child, last in steps:
            node = child.take(node * width + cells.take(base + slot.take(node)))
            if last is not None:
                alive = np.flatnonzero(node != last)
                weight, base, node = weight[alive], base[alive], node[alive]
        for unit in units[tree]:
            mine = slice(None)
            if not unit.whole:
                mine = np.flatnonzero((node >= unit.first) & (node < unit.first + unit.slots.shape[1]))
            own, at, w, begin = node[mine] - unit.first, base[mine], weight[mine], 0
            held = counts[tree, unit.first]
            for slot, start, end in zip(unit.slots, unit.start, unit.ends):
                place = start.take(own)
                place += cells.take(at + slot.take(own))
                held[begin:end] += np.bincount(place, w, end - begin)
                begin = end


def best_splits(unit: Unit, counts: np.ndarray, bins: Bins) -> np.ndarray:
    """Per node ``slot, bin, gain, flip`` and the rows per class on the left and on the right.

    A two-valued category sends the value with the smaller share of the second class left. Where no split
    has rows on both sides the gain is below zero.
    """
    each, nodes = unit.slots.shape
    place = np.arange(bins.width)
    begin = np.concatenate([[0], unit.ends[:-1]])
    first = begin[:, None] + unit.start
    inside = place < bins.sizes[unit.slots][..., None]
    at = np.where(inside, first[..., None] + 2 * place, 0)
    stats = np.where(inside[..., None], counts[np.stack([at, at + 1], -1)], 0).astype(float)
    total = stats[0].sum(1)
    left = np.cumsum(stats, 2)
    two = np.array([c is None for c in bins.cuts])[unit.slots]
    share = np.divide(stats[..., 1], stats.sum(-1), out=np.full(stats.shape[:-1], np.inf), where=stats.sum(-1) > 0)
    flip = two & (share[..., 1] < share[..., 0])
    left[..., 0, :] = np.where(flip[..., None], stats[..., 1, :], left[..., 0, :])
    right = total[:, None] - left
    rows, on_left, on_right = total.sum(-1)[:, None], left.sum(-1), right.sum(-1)
    whole = np.maximum(rows, 1)
    gain = _gini(total[:, None], rows) - on_left / whole * _gini(left, on_left) - on_right / whole * _gini(right, on_right)
    cut = (place < bins.sizes[unit.slots][..., None] - 1) & (on_left > 0) & (on_right > 0)
    gain = np.where(cut, gain, -1.0).transpose(1, 0, 2).reshape(nodes, -1)
    best, node = gain.argmax(1), np.arange(nodes)
    j, b = np.divmod(best, len(place))
    turned = flip[j, node]
    return np.column_stack([
        unit.slots[j, node], np.where(turned, 1, b), gain[node, best], turned, left[j, node, b], right[j, node, b],
    ])


def _groups(trees: list, bins: Bins, each: int) -> list:
    """The units of all open nodes, in groups whose counts fit a task."""
    groups, room = [[]], COUNT_BYTES
    for tree in trees:
        asked = len(tree.open[-1])
        slots = tree.draw(len(bins.sizes), each) if asked else None
        for first in range(0, asked, UNIT_NODES):
            unit = Unit.of(tree.number, first, asked <= UNIT_NODES, slots[:, first:first + UNIT_NODES], bins.sizes)
            size = 8 * int(unit.ends[-1])
            if groups[-1] and size > room:
                groups.append([])
                room = COUNT_BYTES
            groups[-1].append(unit)
            room -= size
    return [g for g in groups if g]


def _search(blocks: DataFrame, trees: list, units: list, bins: Bins, seed: int) -> list:
    """``(tree, first, found)`` of each unit, by one pass over the blocks."""
    by_number = {tree.number: tree for tree in trees}
    steps = {u.tree: by_number[u.tree].steps for u in units}
    context = blocks.sparkSession.sparkContext
    shared = context.broadcast((bins, steps, units))

    def count(batches):
        bins, steps, units = shared.value
        walks, asked, table, counts = {}, {}, _poisson_table(), None
        for batch in batches:
            for block, cells in zip(batch.column("block").to_pylist(), batch.column("cells")):
                if counts is None:
                    counts = {(u.tree, u.first): np.zeros(int(u.ends[-1])) for u in units}
                    for u in units:
                        asked.setdefault(u.tree, []).append(u)
                    for tree, taken in steps.items():
                        walk = []
                        for step in taken:
                            # beyond the numbers of all nodes of the next level
                            last = int(max(step[2].max(initial=-1), step[3].max(initial=-1))) + 1
                            slot, child, ends = _expanded(step, last)
                            walk.append((slot, child, last if ends else None))
                        walks[tree] = (walk, 2 * bins.width)
                _count(
                    np.frombuffer(cells.as_buffer(), np.uint8), block, len(bins.sizes), seed, table, walks, asked, counts
                )
        for (tree, first), held in (counts or {}).items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree], pa.int32()), pa.array([first], pa.int32()),
                 pa.array([held.astype(np.int32).tobytes()], pa.binary())],
                names=["tree", "first", "counts"],
            )

    asked = {(u.tree, u.first): i for i, u in enumerate(units)}

    def choose(table: pa.Table) -> pa.Table:
        bins, _, units = shared.value
        tree, first = table.column("tree")[0].as_py(), table.column("first")[0].as_py()
        unit = units[asked[tree, first]]
        counts = np.zeros(int(unit.ends[-1]), np.int64)
        for held in table.column("counts"):
            counts += np.frombuffer(held.as_buffer(), np.int32)
        found = best_splits(unit, counts, bins)
        return pa.table({
            "tree": pa.array([tree], pa.int32()), "first": pa.array([first], pa.int32()),
            "found": pa.array([found.ravel()], pa.list_(pa.float64())),
        })

    counted = blocks.mapInArrow(count, "tree int, first int, counts binary")
    chosen = counted.groupBy("tree", "first").applyInArrow(choose, "tree int, first int, found array<double>")
    # a few numbers per open node
    rows = chosen.collect()
    shared.destroy()
    return [(r["tree"], r["first"], np.array(r["found"]).reshape(-1, 8)) for r in rows]


# --- a forest ------------------------------------------------------------------------------


def _model(grown: Grown, estimator: RandomForestClassifier) -> RandomForestClassificationModel:
    """The trees as a model of ``pyspark.ml``: stored with the settings of ``estimator``, and loaded.

    The settings come from the same estimator, fitted on two rows; its nodes are then written over.
    """
    spark, slots = grown.spark, len(grown.bins.sizes)
    value = F.col("id").cast("double")
    frame = spark.range(0, 2, 1, 1).select(
        array_to_vector(F.array_repeat(value, slots)).alias("features"), value.alias("label")
    )
    path = new_path(spark, "forest")
    # without the Python side of a model, which asks the JVM for every setting of every tree
    estimator._fit_java(frame).write().overwrite().save(path)
    tables = []
    for tree in grown.trees[:estimator.getNumTrees()]:
        nodes = tree.pruned(grown.bins, estimator.getMaxDepth())
        stats, count = nodes["stats"], nodes["stats"].sum(1)
        split = pa.StructArray.from_arrays(
            [pa.array(nodes["slot"], pa.int32()), pa.array(nodes["value"], pa.list_(pa.float64())),
             pa.array(nodes["categories"], pa.int32())],
            ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
        )
        data = pa.StructArray.from_arrays(
            [pa.array(nodes["number"], pa.int32()), pa.array(stats.argmax(1).astype(float)),
             pa.array(_gini(stats, count)), pa.array(list(stats), pa.list_(pa.float64())),
             pa.array(count.astype(np.int64)), pa.array(nodes["gain"]), pa.array(nodes["left"], pa.int32()),
             pa.array(nodes["right"], pa.int32()), split],
            ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"],
        )
        tables.append(pa.table({"treeID": pa.array(np.full(len(data), tree.number), pa.int32()), "nodeData": data}))
    spark.createDataFrame(pa.concat_tables(tables)).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return load_forest(path)


class Grown:
    """The trees of one table and seed, from which forests of up to ``num_trees`` and ``max_depth`` are taken.

    What a tree draws depends on the seed, its number and the level alone. So a smaller forest is the first
    trees of a larger one, cut at its depth, node for node as if it were fitted by itself, and forests of
    several sizes are grown once. (A forest of one tree looks at every slot, and shares with no other.)
    """

    def __init__(self, train: DataFrame, num_trees: int, max_depth: int, seed: int):
        self.spark, self.train = train.sparkSession, train.select("features", "label")
        self.num_trees, self.max_depth, self.seed = num_trees, max_depth, seed
        self.bins, self.trees = None, None

    def has(self, num_trees: int, max_depth: int, seed: int) -> bool:
        alike = seed == self.seed and (num_trees == 1) == (self.num_trees == 1)
        return alike and num_trees <= self.num_trees and max_depth <= self.max_depth

    def grow(self) -> None:
        """No trees where labels are not 0 and 1, one class is absent, or a category has more than two values."""
        label = F.col("label")
        sums = self.train.agg(
            F.count("*").alias("rows"), F.sum(label.isin(0.0, 1.0).cast("long")).alias("known"),
            F.max(label).alias("top"),
        ).first()
        categories, self.trees = _two_valued(self.train), []
        if categories is None or self.max_depth < 1 or sums["top"] != 1.0 or sums["known"] != sums["rows"]:
            return
        self.bins = _fit_bins(self.train, sums["rows"], self.seed, categories)
        slots = len(self.bins.sizes)
        each = slots if self.num_trees == 1 else math.ceil(math.sqrt(slots))
        path = new_path(self.spark, "binned")
        _binned(self.train, self.bins).write.parquet(path)
        blocks = self.spark.read.schema("block long, cells binary").parquet(path)
        self.trees = [Growing(number, self.seed) for number in range(self.num_trees)]
        for _ in range(self.max_depth):
            found = {}
            for units in _groups(self.trees, self.bins, each):
                for tree, first, splits in _search(blocks, self.trees, units, self.bins, self.seed):
                    found.setdefault(tree, {})[first] = splits
            for tree, parts in found.items():
                splits = np.concatenate([parts[first] for first in sorted(parts)])
                self.trees[tree].grow(splits, self.bins, self.max_depth)
        remove(self.spark, path)

    def forest(self, estimator: RandomForestClassifier) -> RandomForestClassificationModel:
        """The forest that ``estimator`` asks for; its own fit where no trees can be grown here."""
        wanted = estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getSeed()
        if not self.has(*wanted):
            return Grown(self.train, *wanted).forest(estimator)
        if self.trees is None:
            self.grow()
        return _model(self, estimator) if self.trees else estimator.fit(self.train)
