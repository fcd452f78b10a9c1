"""Decisions for customer rows as they arrive.

The decision is row-wise: no state, no watermark, the same functions as for a table.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from respondry.operators.cleaning import CleaningModel
from respondry.operators.decisions import decide
from respondry.plans.preparation import score_contacts
from respondry.spec import CONTACTS, TableSpec, contact_schema


def incoming_contacts(
    spark: SparkSession, folder: str, schema: StructType | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """Stream over the parquet files that appear in a folder."""
    return (
        spark.readStream.schema(schema or contact_schema("contact_id"))
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def decided(
    contacts: DataFrame,
    cleaning: CleaningModel,
    features_model: PipelineModel,
    forest: RandomForestClassificationModel,
    spec: TableSpec = CONTACTS,
) -> DataFrame:
    return decide(score_contacts(contacts, cleaning, features_model, forest, spec), spec.key)


def start_decisions(decisions: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write decisions as parquet; the checkpoint makes each input file count once."""
    return (
        decisions.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
