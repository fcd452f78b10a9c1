"""Feature importances with names."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv
from respondry.spec import CONTACTS, TableSpec


def names_from_labels(model: PipelineModel, spec: TableSpec = CONTACTS) -> list[tuple[str, str]]:
    """``(feature, source column)`` from the fitted category order; the last category has none."""
    indexer = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    named = [
        (f"{column}_{value}", column)
        for column, labels in zip(spec.categorical, indexer.labelsArray)
        for value in labels[:-1]
    ]
    return named + [(c, c) for c in spec.numeric]


def names_from_metadata(features: DataFrame, spec: TableSpec = CONTACTS) -> list[tuple[str, str]]:
    """``(feature, source column)`` per slot, read from the vector column's metadata."""
    attrs = features.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a for kind in attrs.values() for a in kind), key=lambda a: a["idx"])
    named = []
    for slot in slots:
        block, _, value = slot["name"].partition("_encoded_")
        if value and block in spec.categorical:
            named.append((f"{block}_{value}", block))
        else:
            column = spec.numeric[int(slot["name"].rsplit("_", 1)[1])]
            named.append((column, column))
    return named


def fitted_names(named: list[tuple[str, str]], size: int) -> list[tuple[str, str]]:
    """Exactly ``size`` names: cut when too many, ``feature_<i>`` when too few."""
    generic = [(f"feature_{i}", f"feature_{i}") for i in range(len(named), size)]
    return (named + generic)[:size]


def _importances(model: RandomForestClassificationModel, named: list[tuple[str, str]]) -> DataFrame:
    """``(position, feature, source, importance)``, one row per vector slot."""
    values = [float(v) for v in model.featureImportances.toArray()]
    rows = [(i, *name, v) for i, (name, v) in enumerate(zip(fitted_names(named, len(values)), values))]
    return SparkSession.active().createDataFrame(
        rows, "position int, feature string, source string, importance double"
    )


def feature_importance(
    model: RandomForestClassificationModel, named: list[tuple[str, str]], top: int = fv.TOP_FEATURES
) -> DataFrame:
    """The ``top`` features: rank, name, importance and display text."""
    order = [F.desc("importance"), F.asc("position")]
    return (
        _importances(model, named)
        .orderBy(*order)
        .limit(top)
        .withColumn("rank", F.row_number().over(Window.orderBy(*order)))
        .select(
            "rank", "feature", "importance",
            F.format_string("%d. %s: %.4f", "rank", "feature", "importance").alias("display"),
        )
    )


def importance_by_source(
    model: RandomForestClassificationModel, named: list[tuple[str, str]]
) -> DataFrame:
    """Importance summed over the slots of each original column."""
    return (
        _importances(model, named)
        .groupBy("source")
        .agg(F.sum("importance").alias("importance"))
        .orderBy(F.desc("importance"), "source")
    )
