import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from respondry.operators import forests, training, trees

BINARY = {"ml_attr": {"attrs": {"binary": [{"idx": 2, "name": "c"}]}, "num_attrs": 5}}


def table(spark, rows=4000, files=4, metadata=None):
    """Five slots, the third of them 0 or 1; the label leans on three of them."""
    n = F.col("id")
    entries = [(n * 7 % 101) / 10.0, (n * n) % 17, (n % 3 == 0).cast("int"), F.lit(1), (n * 13) % 400 - 50]
    vector = array_to_vector(F.array(*[e.cast("double") for e in entries]))
    lean = ((n * 7 % 101) > 60).cast("int") + (n % 3 == 0).cast("int") + ((n * n) % 17 > 8).cast("int")
    return spark.range(0, rows, 1, files).select(
        vector.alias("features", metadata=metadata or BINARY), (lean + n % 2 >= 2).cast("double").alias("label")
    )


def nodes(spark, model):
    rows = trees.node_table(spark, model).collect()
    return sorted((r.asDict() for r in rows), key=lambda r: (r["tree"], r["node"]))


def test_smaller_forests_are_those_fitted_alone(spark):
    train = table(spark)
    grown = forests.Grown(train, 6, 6, 7)
    for count, depth in ((3, 6), (6, 2)):
        shared = training.fit_forest(train, count, depth, 7, grown)
        alone = training.fit_forest(train, count, depth, 7, forests.Grown(train, count, depth, 7))
        assert (shared.getNumTrees, shared.getMaxDepth(), shared.numFeatures) == (count, depth, 5)
        assert max(t.depth for t in shared.trees) <= depth
        assert nodes(spark, shared) == nodes(spark, alone)


def test_nodes_add_up_and_gain(spark):
    train = table(spark)
    model = training.fit_forest(train, 5, 5, 3, forests.Grown(train, 5, 5, 3))
    by_place = {(n["tree"], n["node"]): n for n in nodes(spark, model)}
    roots = [n for (_, place), n in by_place.items() if place == 0]
    assert len(roots) == 5 and all(abs(sum(n["stats"]) - 4000) < 5 * math.sqrt(4000) for n in roots)

    def gini(stats):
        return 1 - sum((x / sum(stats)) ** 2 for x in stats)

    inner = [n for n in by_place.values() if n["left"] >= 0]
    assert {n["feature"] for n in inner} == {0, 1, 2, 4} and len(inner) > 20
    for n in inner:
        pair = [by_place[n["tree"], n[side]] for side in ("left", "right")]
        assert n["stats"] == [a + b for a, b in zip(*[x["stats"] for x in pair])]
        shares = [sum(x["stats"]) / sum(n["stats"]) for x in pair]
        gain = gini(n["stats"]) - sum(s * gini(x["stats"]) for s, x in zip(shares, pair))
        assert abs(n["gain"] - gain) < 1e-9 and n["gain"] > 0
        assert n["continuous"] == (n["feature"] != 2)
        # twin leaves of one prediction are joined
        assert pair[0]["left"] >= 0 or pair[1]["left"] >= 0 or len({x["stats"][0] >= x["stats"][1] for x in pair}) == 2
    scored = training.score(train, model)
    walked = trees.with_walked_scores(scored, trees.node_table(spark, model), 5, 5, ["p_yes"])
    assert walked.filter(F.abs(F.col("walked") - F.col("p_yes")) > 1e-9).isEmpty()


def test_rows_of_a_node_are_those_that_walk_there(spark, monkeypatch):
    """With every weight 1, the leaves hold the table's own rows."""
    monkeypatch.setattr(forests, "_poisson_table", lambda: np.ones(2**16, np.uint8))
    train = table(spark, 900, 3)
    model = training.fit_forest(train, 2, 4, 1, forests.Grown(train, 2, 4, 1))
    rows = [(r["features"], r["label"]) for r in train.collect()]
    for number in range(2):
        mine = {n["node"]: n for n in nodes(spark, model) if n["tree"] == number}
        counts = {}
        for vector, label in rows:
            at = mine[0]
            while at["left"] >= 0:
                value, cut = vector[at["feature"]], at["goes_left"]
                at = mine[at["left"] if (value <= cut[0] if at["continuous"] else value in cut) else at["right"]]
            counts.setdefault(at["node"], [0, 0])[int(label)] += 1
        assert counts == {n: [int(x) for x in r["stats"]] for n, r in mine.items() if r["left"] < 0}


def test_counts_in_parts_give_the_same_forest(spark, monkeypatch):
    train = table(spark)
    whole = nodes(spark, forests.Grown(train, 4, 6, 5).forest(training.forest(4, 6, 5)))
    monkeypatch.setattr(forests, "UNIT_NODES", 3)
    monkeypatch.setattr(forests, "COUNT_BYTES", 6000)
    assert nodes(spark, forests.Grown(train, 4, 6, 5).forest(training.forest(4, 6, 5))) == whole


def test_best_splits_against_all_splits():
    rng = np.random.default_rng(3)
    bins = forests.Bins([np.arange(4.0), None, np.arange(2.0), np.zeros(0)], np.array([5, 2, 3, 1]))
    slots = np.array([[0, 1, 0], [1, 2, 3]])
    unit = forests.Unit.of(0, 0, True, slots, bins.sizes)
    counts, held = np.zeros(int(unit.ends[-1]), int), {}
    for node in range(3):
        rows = [(rng.integers(0, bins.sizes), rng.integers(0, 2)) for _ in range(40)]
        for j, slot in enumerate(slots[:, node]):
            begin = (0, unit.ends[0])[j] + unit.start[j, node]
            for row, label in rows:
                counts[begin + 2 * row[slot] + label] += 1
        held[node] = rows

    def gini(labels):
        return 1 - (np.bincount(labels, minlength=2) ** 2).sum() / len(labels) ** 2

    for node, (slot, cut, gain, flip, *sides) in enumerate(forests.best_splits(unit, counts, bins)):
        labels, gains = np.array([label for _, label in held[node]]), []
        for s in slots[:, node]:
            values = np.array([row[s] for row, _ in held[node]])
            for b in range(bins.sizes[s] - 1):
                low = values <= b
                if low.any() and not low.all():
                    gains.append(gini(labels) - low.mean() * gini(labels[low]) - (~low).mean() * gini(labels[~low]))
        assert abs(gain - max(gains)) < 1e-12
        values = np.array([row[int(slot)] for row, _ in held[node]])
        low = values == cut if bins.cuts[int(slot)] is None else values <= cut
        assert sides == [(~labels[low].astype(bool)).sum(), labels[low].sum(), (~labels[~low].astype(bool)).sum(), labels[~low].sum()]
        if bins.cuts[int(slot)] is None:
            assert labels[low].mean() <= labels[~low].mean()


def test_as_good_as_sparks_own(spark):
    train = table(spark, 6000)
    held_out = table(spark, 9000).subtract(train)
    own, theirs = (training.fit_forest(train, 20, 5, 1, g) for g in (forests.Grown(train, 20, 5, 1), None))
    areas = [training.auc(training.score(held_out, m)) for m in (own, theirs)]
    assert areas[0] > areas[1] - 0.01 and areas[1] > 0.8
    assert np.abs(own.featureImportances.toArray() - theirs.featureImportances.toArray()).max() < 0.1


def test_cuts():
    assert forests.find_cuts(np.array([3.0, 1.0, 1.0, np.nan]), 31).tolist() == [2.0]
    assert len(forests.find_cuts(np.zeros(5), 31)) == 0
    many = forests.find_cuts(np.arange(1000.0), 31)
    parts = np.diff(np.concatenate([[-1], np.searchsorted(np.arange(1000.0), many), [1000]]))
    assert len(many) == 31 and parts.min() > 20 and parts.max() < 45


@pytest.mark.parametrize("case", ["three labels", "three values", "one class"])
def test_what_is_left_to_spark(spark, case):
    train = table(spark, 300)
    if case == "three values":
        nominal = {"ml_attr": {"attrs": {"nominal": [{"idx": 2, "name": "c", "vals": ["a", "b", "d"]}]}, "num_attrs": 5}}
        train = table(spark, 300, metadata=nominal)
    elif case == "three labels":
        train = train.withColumn("label", F.col("label") + F.rand(1).__gt__(0.5).cast("int"))
    else:
        train = train.withColumn("label", F.lit(0.0))
    grown = forests.Grown(train, 2, 2, 1)
    assert grown.forest(training.forest(2, 2, 1)).getNumTrees == 2 and grown.trees == []


def test_a_search_grows_each_fold_once(spark, monkeypatch):
    train = table(spark, 600).withColumn("row_key", F.monotonically_increasing_id())
    grown, grow = [], forests.Grown.grow
    monkeypatch.setattr(forests.Grown, "grow", lambda self: grown.append((self.num_trees, self.max_depth)) or grow(self))
    training.grid_search(train, num_trees=(2, 3), max_depths=(2, 3), folds=2)
    assert grown[:2] == [(3, 3), (3, 3)] and len(grown) == 3
