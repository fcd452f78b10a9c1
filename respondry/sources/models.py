"""Saving and loading fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_features_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_forest(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)
