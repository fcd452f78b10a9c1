import re

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from respondry.operators import decisions, evaluation, influence, training
from respondry.plans import preparation
from respondry.sources import derived, models
from respondry.spec import contact_schema
from respondry.streaming import decisions as streaming


@pytest.fixture(scope="module")
def fitted(spark):
    prepared = preparation.prepare(derived.contact_table(spark, "/root/testdata/sf0.01"))
    balanced = preparation.balanced_training_table(prepared)
    return prepared, balanced, training.fit_forest(balanced, 10, 5)


def test_scores_are_probabilities(fitted):
    prepared, _, model = fitted
    scored = training.score(prepared.split("test"), model)
    p = vector_to_array("probability")
    row = scored.agg(F.min("p_yes"), F.max("p_yes"), F.max(F.abs(p[0] + p[1] - 1))).first()
    assert 0 <= row[0] <= row[1] <= 1 and row[2] < 1e-9
    assert training.auc(scored) > 0.6


def test_report_agrees_with_the_evaluators(fitted):
    prepared, _, model = fitted
    scored = training.score(prepared.split("test"), model).cache()
    report = evaluation.evaluation_report(scored).first()
    multi = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for column, metric in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                           ("weighted_recall", "weightedRecall"), ("f1", "f1")):
        expected = multi.evaluate(scored, {multi.metricName: metric})
        assert abs(report[column] - expected) < 1e-9
    assert abs(report["auc"] - training.auc(scored)) < 0.005
    scored.unpersist()


def test_balanced_table(fitted):
    _, balanced, _ = fitted
    sizes = {r["label"]: r["count"] for r in balanced.groupBy("label").count().collect()}
    assert sizes[0.0] == sizes[1.0]


def test_saved_models_score_the_same(fitted, spark, tmp_path):
    prepared, _, model = fitted
    forest = models.load_forest(models.save_model(model, str(tmp_path / "forest")))
    steps = models.load_features_model(
        models.save_model(prepared.features_model, str(tmp_path / "features"))
    )
    raw = derived.contact_table(spark, "/root/testdata/sf0.001").drop("y")
    before = preparation.score_contacts(raw, prepared.cleaning, prepared.features_model, model)
    after = preparation.score_contacts(raw, prepared.cleaning, steps, forest)
    columns = ["contact_id", "p_yes", "prediction"]
    assert before.select(columns).exceptAll(after.select(columns)).isEmpty()


def test_unseen_and_missing_categories_are_scored(fitted, spark):
    prepared, _, model = fitted
    raw = derived.contact_table(spark, "/root/testdata/sf0.001").limit(20).withColumn(
        "job", F.when(F.col("contact_id") % 2 == 0, "astronaut")
    )
    scored = preparation.score_contacts(raw, prepared.cleaning, prepared.features_model, model)
    assert scored.filter("p_yes is not null").count() == 20


def test_importances_have_names(fitted):
    prepared, _, model = fitted
    named = influence.names_from_metadata(prepared.features)
    assert named == influence.names_from_labels(prepared.features_model)
    assert len(named) == model.numFeatures
    top = influence.feature_importance(model, named).collect()
    assert [r["rank"] for r in top] == list(range(1, 16))
    assert all(a["importance"] >= b["importance"] for a, b in zip(top, top[1:]))
    assert top[0]["display"] == f"1. {top[0]['feature']}: {top[0]['importance']:.4f}"
    total = influence.importance_by_source(model, named).agg(F.sum("importance")).first()[0]
    assert abs(total - 1) < 1e-9


def test_names_are_cut_or_filled(fitted):
    assert influence.fitted_names([("a", "a"), ("b", "b")], 1) == [("a", "a")]
    assert influence.fitted_names([("a", "a")], 2)[1] == ("feature_1", "feature_1")


def test_grid_search_reports_every_point(fitted):
    _, balanced, _ = fitted
    model, report = training.grid_search(balanced, num_trees=(3, 6), max_depths=(2, 4))
    rows = report.collect()
    assert len(rows) == 4 and sum(r["is_best"] for r in rows) == 1
    best = max(rows, key=lambda r: r["avg_auc"])
    assert best["is_best"]
    assert (model.getNumTrees, model.getMaxDepth()) == (best["num_trees"], best["max_depth"])


def test_stream_decides_like_a_table(fitted, spark, tmp_path):
    prepared, _, model = fitted
    raw = derived.contact_table(spark, "/root/testdata/sf0.001").drop("y", "duration")
    folder = str(tmp_path / "in")
    raw.repartition(3).write.parquet(folder)
    schema = contact_schema("contact_id")
    schema = type(schema)([f for f in schema.fields if f.name not in ("y", "duration")])
    arriving = streaming.incoming_contacts(spark, folder, schema, files_per_batch=1)
    decided = streaming.decided(arriving, prepared.cleaning, prepared.features_model, model)
    query = streaming.start_decisions(decided, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out"))
    scored = preparation.score_contacts(raw, prepared.cleaning, prepared.features_model, model)
    expected = decisions.decide(scored)
    assert stored.count() == 1500
    assert expected.select(stored.columns).exceptAll(stored).isEmpty()


def test_a_search_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    rows = [(i, Vectors.dense([float(i % 10), float(i % 7)]), float(i % 10 > 4)) for i in range(300)]
    train = spark.createDataFrame(rows, ["row_key", "features", "label"])
    fits, fit = [], training.fit_forest
    monkeypatch.setattr(training, "fit_forest", lambda *a: fits.append(a[1:3]) or fit(*a))
    folder = f"file://{tmp_path}/search"
    settings = {"num_trees": (2, 3), "max_depths": (2,), "folds": 2, "folder": folder}
    first = training.grid_search(train, **settings)[1].collect()
    assert len(fits) == 5  # two points, two folds, the refit
    # one part never ended: only that one is fitted again, and the best point
    (tmp_path / "search/num_trees=3/max_depth=2/fold=1/_SUCCESS").unlink()
    fits.clear()
    again = training.grid_search(train, **settings)[1].collect()
    assert again == first and sorted(fits)[-1] == (3, 2) and len(fits) == 2
    held_out = training.search_results(spark, folder)
    assert held_out.count() == 600
    counts = evaluation.outcome_counts(held_out, ["num_trees", "fold"])
    areas = evaluation.curve_areas(counts, ["num_trees", "fold"]).groupBy("num_trees").agg(F.avg("roc_auc").alias("auc"))
    expected = {r["num_trees"]: r["auc"] for r in areas.collect()}
    assert all(abs(expected[r["num_trees"]] - r["avg_auc"]) < 1e-9 for r in first)


def test_the_tasks_of_a_search_are_alike(spark, monkeypatch):
    def table(first, rows, files):
        numbers = spark.range(first, first + rows, 1, files)
        vector = array_to_vector(F.array((F.col("id") % 10).cast("double"), (F.col("id") % 7).cast("double")))
        return numbers.select(F.col("id").alias("row_key"), vector.alias("features"), (F.col("id") % 10 > 4).cast("double").alias("label"))

    tasks, fit = [], training.fit_forest

    def watched(train, *a):
        tasks.append([r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()])
        return fit(train, *a)

    monkeypatch.setattr(training, "fit_forest", watched)
    # one partition holds nearly all rows
    train = table(0, 9000, 1).unionByName(table(9000, 1000, 7))
    training.grid_search(train, num_trees=(2,), max_depths=(2,), parallelism=1)
    assert len(tasks) == 4 and sum(tasks[-1]) == 10000
    assert all(max(rows) < 2 * sum(rows) / len(rows) and len(rows) >= 8 for rows in tasks)


def test_kept_nodes_change_no_tree(spark, monkeypatch):
    rows = [(Vectors.dense([float(i % 10), float(i % 7), float(i % 3)]), float(i * i % 11 > 5)) for i in range(400)]
    train = spark.createDataFrame(rows, ["features", "label"]).coalesce(1)
    kept = training.fit_forest(train, 3, 7)
    assert training.forest(3, 7).getCacheNodeIds()
    monkeypatch.setattr(training, "WALKED_DEPTH", 7)
    assert not training.forest(3, 7).getCacheNodeIds()
    walked = training.fit_forest(train, 3, 7)
    assert [t.toDebugString.split("\n", 1)[1] for t in kept.trees] == [t.toDebugString.split("\n", 1)[1] for t in walked.trees]


def test_a_split_reads_only_its_own_rows(fitted, spark):
    prepared, _, _ = fitted
    for names in (("train",), ("val", "test")):
        part = prepared.split(*names)
        expected = prepared.features.filter(F.col("split").isin(*names))
        assert part.columns == expected.columns
        keys = part.select("contact_id", "split")
        assert keys.exceptAll(expected.select(keys.columns)).isEmpty() and keys.count() == expected.count()
        scan = part.select("features")._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*split", scan)
