"""The whole application: build the model from raw contacts, then report on scored customers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv
from respondry.operators import (
    dashboard,
    evaluation,
    influence,
    risk,
    segments,
    simulation,
    splitting,
    training,
)
from respondry.operators.cleaning import CleaningModel
from respondry.plans import preparation
from respondry.sources import models, tables
from respondry.spec import CONTACTS, TableSpec


@dataclass(frozen=True)
class Models:
    """The three fitted parts a customer needs to be scored."""

    cleaning: CleaningModel
    features: PipelineModel
    forest: RandomForestClassificationModel

    def save(self, spark: SparkSession, folder: str) -> str:
        self.cleaning.save(spark, f"{folder}/cleaning")
        models.save_model(self.features, f"{folder}/features")
        models.save_model(self.forest, f"{folder}/forest")
        return folder

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Models:
        return cls(
            CleaningModel.load(spark, f"{folder}/cleaning"),
            models.load_features_model(f"{folder}/features"),
            models.load_forest(f"{folder}/forest"),
        )


def build(
    raw: DataFrame,
    out: str,
    spec: TableSpec = CONTACTS,
    fit_on: str = "all",
    num_trees=fv.GRID_NUM_TREES,
    max_depths=fv.GRID_MAX_DEPTH,
    parallelism: int = 2,
) -> tuple[Models, dict[str, DataFrame]]:
    """Prepare, balance, search, evaluate. Writes ``train``, ``val``, ``test`` and ``models``.

    A table without the key column gets one.
    """
    spark = raw.sparkSession
    if spec.key not in raw.columns:
        raw = tables.with_row_key(raw, spec.key)
    prepared = preparation.prepare(raw, spec, fit_on)
    balanced = preparation.balanced_training_table(prepared, spec)
    tables.write_table(balanced, f"{out}/train")
    for name in ("val", "test"):
        tables.write_table(prepared.split(name), f"{out}/{name}")
    forest, grid = training.grid_search(
        balanced, "row_key", num_trees, max_depths, parallelism=parallelism
    )
    fitted = Models(prepared.cleaning, prepared.features_model, forest)
    fitted.save(spark, f"{out}/models")
    held_out = prepared.split("val", "test")
    named = influence.names_from_metadata(prepared.features, spec)
    reports = {
        "split_sizes": splitting.split_sizes(preparation.split_report_rows(prepared, balanced)),
        "grid": grid,
        "evaluation": evaluation.evaluation_report(training.score(held_out, forest)),
        "feature_importance": influence.feature_importance(forest, named),
        "importance_by_source": influence.importance_by_source(forest, named),
    }
    return fitted, reports


def report(
    features: DataFrame, forest: RandomForestClassificationModel, out: str, spec: TableSpec = CONTACTS
) -> dict[str, DataFrame]:
    """Score a feature table once and derive every report from the stored result.

    Writes ``segments`` (scores and segments, also the simulation's table) and ``risk``.
    """
    spark = features.sparkSession
    scored = segments.segment_customers(training.score(features, forest))
    tables.write_table(scored, f"{out}/segments")
    segmented = tables.read_table(spark, f"{out}/segments")
    tables.write_table(risk.rank_customers(risk.assess_risk(segmented)), f"{out}/risk")
    assessed = tables.read_table(spark, f"{out}/risk")
    return {
        "segment_stats": segments.segment_stats(segmented),
        "strategies": simulation.compare_strategies(segmented, spec.key),
        "risk_summary": risk.risk_summary(assessed),
        "risk_counts": risk.risk_counts(assessed),
        "risk_marginals": risk.risk_marginals(assessed),
        "top_at_risk": dashboard.top_at_risk(assessed, spec.key),
        "score_profile": dashboard.score_profile(assessed),
        "score_histogram": dashboard.score_histogram(assessed),
        "risk_correlation": dashboard.risk_correlation(assessed),
    }
