"""Scoring keeps every row, whichever number is missing; node tables agree with their forest."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv
from respondry.operators import decisions, training, trees
from respondry.operators.cleaning import CleaningModel
from respondry.plans import preparation
from respondry.sources import derived
from respondry.sources.workspace import new_path, written
from respondry.streaming import decisions as arrivals


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    raw = written(derived.contact_table(spark, sf_dir), "contacts")
    prepared = preparation.prepare(raw)
    train = prepared.split("train").select("features", "label")
    return raw, prepared, training.fit_forest(train, 3, 3)


@pytest.mark.parametrize("column", fv.NUMERIC_COLUMNS)
def test_a_null_number_is_scored(spark, fitted, column):
    raw, prepared, model = fitted
    kind = raw.schema[column].dataType
    spoilt = raw.limit(40).withColumn(column, F.lit(None).cast(kind))
    scored = preparation.score_contacts(spoilt, prepared.cleaning, prepared.features_model, model)
    assert scored.schema[column].dataType == kind
    decided = decisions.decide(scored).collect()
    assert len(decided) == 40 and all(r["probability"] for r in decided)


def test_scoring_means_survive_saving_and_leave_training_alone(spark, fitted):
    raw, prepared, _ = fitted
    again = CleaningModel.load(spark, prepared.cleaning.save(spark, new_path(spark, "cleaning")))
    assert again == prepared.cleaning and set(again.scoring_means) == {"age", "campaign", "pdays", "previous"}
    spoilt = raw.withColumn("campaign", F.lit(None).cast("int"))
    assert again.transform(spoilt).filter("campaign is not null").count() == 0
    assert again.transform(spoilt, filter_rows=False).filter("campaign is null").count() == 0


def test_node_table_of_a_forest(spark, fitted):
    _, prepared, model = fitted
    nodes = trees.node_table(spark, model)
    assert nodes.select("tree").distinct().count() == 3
    scored = training.score(prepared.features, model)
    walked = trees.walked_scores(scored, "contact_id", nodes, 3, 3)
    both = scored.join(walked, "contact_id")
    assert both.count() == prepared.features.count()
    assert both.filter(F.abs(F.col("walked") - F.col("p_yes")) > 1e-9).count() == 0
    gained = {r["position"]: r["gained"] for r in trees.gain_importance(nodes).collect()}
    for i, value in enumerate(model.featureImportances.toArray()):
        assert abs(gained.get(i, 0.0) - value) < 1e-9


def test_a_stump_has_no_importance(spark):
    """A forest of one leaf per tree: equal rows leave nothing to split on."""
    rows = spark.createDataFrame([(1, 1.0), (2, 0.0)], "contact_id long, label double")
    table = rows.withColumn("features", array_to_vector(F.array(F.lit(1.0), F.lit(2.0))))
    model = training.fit_forest(table, 2, 2)
    nodes = trees.node_table(spark, model)
    assert trees.gain_importance(nodes).count() == 0
    walked = trees.walked_scores(training.score(table, model), "contact_id", nodes, 2, 2)
    assert walked.count() == 2


def test_a_stream_goes_on_after_a_failure(spark, sf_dir, tmp_path):
    """Batches that were written before the failure count once, the others are done by the next start."""
    scored = derived.scored(spark, sf_dir).limit(240).cache()
    scored.repartition(6).write.parquet(f"{tmp_path}/in")
    expected = decisions.decide(scored).select("contact_id", "potential", "churn_risk")

    def start(broken):
        arriving = arrivals.incoming_contacts(spark, f"{tmp_path}/in", scored.schema, files_per_batch=1)
        decided = decisions.decide(arriving).select("contact_id", "potential", "churn_risk")
        if broken is not None:
            risk = F.when(F.col("contact_id") == broken, F.raise_error(F.lit("stop"))).otherwise(F.col("churn_risk"))
            decided = decided.withColumn("churn_risk", risk)
        arrivals.start_decisions(decided, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()

    broken = spark.read.parquet(f"{tmp_path}/in").orderBy(F.desc(F.col("_metadata.file_path"))).first()["contact_id"]
    with pytest.raises(Exception, match="stop"):
        start(broken)
    start(None)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.exceptAll(expected).isEmpty() and got.count() == 240
