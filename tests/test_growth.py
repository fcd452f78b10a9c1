"""Steps whose cost must not grow faster than the input."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from respondry.operators import neighbours, oversampling, training, trees
from respondry.plans import catalogue


def test_hashes_are_not_taken_per_vector_entry(spark):
    rows = [(i, float(i % 5 == 0), [float(i % 13), float(i % 7)]) for i in range(200)]
    train = spark.createDataFrame(rows, "contact_id long, label double, features array<double>")
    plan = oversampling.oversample(train)._jdf.queryExecution().optimizedPlan().toString()
    moved = [line for line in plan.splitlines() if "zip_with" in line]
    assert moved and not any("md5" in line for line in moved)


def test_repeated_keys_get_their_copies(spark):
    rows = [(i // 2, 1.0, [float(i % 13), float(i % 7)]) for i in range(60)]
    points = spark.createDataFrame(rows, "id long, label double, vec array<double>")
    sizes, missing = {1.0: 60}, {1.0: 150}
    got = oversampling.synthetic_points(points, "label", "id", missing, sizes)
    assert got.count() >= 150


def test_both_ways_of_drawing_agree(spark):
    rows = [(i, 1.0, [float(i % 13), float(i * i % 17)]) for i in range(80)]
    points = spark.createDataFrame(rows, "id long, label double, vec array<double>")
    copies = F.lit(4)
    columns = ["id", "copy", "step", "mate_key", "mate_vec", "vec"]
    one = oversampling._drawn(points, "label", "id", copies, 5, 42).select(columns).collect()
    other = oversampling._drawn_by_blocks(points, "label", "id", copies, 5, 42).select(columns).collect()
    assert sorted(one) == sorted(other) and len(one) == 320


def test_walk_does_not_shuffle_rows(spark):
    rows = spark.range(200).select(
        F.col("id").alias("contact_id"), (F.col("id") % 3 == 0).cast("double").alias("label"),
        array_to_vector(F.array((F.col("id") % 9).cast("double"), (F.col("id") % 5).cast("double"))).alias("features"),
    )
    model = training.fit_forest(rows, 3, 4)
    scored = training.score(rows, model)
    walked = trees.with_walked_scores(scored, trees.node_table(spark, model), 3, 4, ["contact_id", "p_yes"])
    plan = walked._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    assert walked.filter(F.abs(F.col("walked") - F.col("p_yes")) < 1e-9).count() == 200


def test_points_between_their_parents():
    vectors = pa.list_(pa.float64())
    batch = pa.RecordBatch.from_arrays([
        pa.array([1.0] * 5),
        pa.array([[1.0, 1.0], [1.0, 2.0], [3.0, 3.0], [0.0, 0.0], [5.0, 5.0]], vectors),
        pa.array([[0.0, 0.0]] * 4 + [None], vectors),
        pa.array([[[0.0, 9.0], [2.0, 2.0]], [[2.0, 2.0]], [[2.0, 2.0]], [], None], pa.list_(vectors)),
    ], names=["label", "point", "own", "others"])
    found = next(catalogue._lies_between([batch])).column("between").to_pylist()
    # on the way, beside it, beyond it, alone, without a parent
    assert found == [True, False, False, True, False]


def test_a_tree_is_grown_without_copies_of_the_block():
    rows = np.random.default_rng(1).random((100_000, 64))
    assert np.allclose(neighbours._variance(rows, np.arange(1000)), rows[:1000].var(0))
    tracemalloc.start()
    neighbours.grow_tree(rows, 60_000)
    assert tracemalloc.get_traced_memory()[1] < rows.nbytes
    tracemalloc.stop()
