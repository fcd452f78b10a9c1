"""Feature vectors: category numbers, one-hot blocks, scaled numerics."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respondry.operators.cleaning import value_counts
from respondry.operators.cumulative import running_totals
from respondry.sources.workspace import written
from respondry.spec import CONTACTS, TableSpec


#: A value is frequent if more than one row in so many has it.
HOT_VALUES = 1000


def frequency_labels(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Values of each column, most frequent first, ties alphabetical.

    All columns are counted in one job; what reaches the driver is the category lists.
    """
    labels: dict[str, list[tuple[int, str]]] = {c: [] for c in columns}
    for row in value_counts(df, columns).collect():
        labels[row["column"]].append((-row["count"], row["value"]))
    return {c: [value for _, value in sorted(pairs)] for c, pairs in labels.items()}


def index_expression(column: str, labels: list[str]) -> Column:
    numbers = [F.when(F.col(column) == v, float(i)) for i, v in enumerate(labels)]
    return F.coalesce(*numbers) if numbers else F.lit(None).cast("double")


def frequency_index(
    df: DataFrame, columns: list[str], labels: dict[str, list[str]] | None = None
) -> DataFrame:
    """Add ``<column>_index`` as a plain expression; an unseen value gets null."""
    labels = labels or frequency_labels(df, columns)
    return df.withColumns({f"{c}_index": index_expression(c, labels[c]) for c in columns})


def category_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, count, number)``: values numbered by falling frequency, ties alphabetical.

    The numbers of :func:`frequency_labels` as a table: values are ranked in ranges, so there may be any
    number of them and none reaches the driver. Written, as it is read once per column.
    """
    counts = value_counts(df, columns).withColumns({
        "place": F.struct((-F.col("count")).alias("order"), F.col("value").alias("name")), "one": F.lit(1),
    })
    ranked = running_totals(counts, "place", ["one"], ["column"])
    number = (F.col("one_total") - 1).cast("double").alias("number")
    return written(ranked.select("column", "value", "count", number), "dictionary")


def index_by_dictionary(
    df: DataFrame, columns: list[str], dictionary: DataFrame, key: str
) -> DataFrame:
    """Add ``<column>_index`` by joins with a :func:`category_dictionary`; an unseen value gets null.

    Values with more than one row in :data:`HOT_VALUES`, at most so many per column, are broadcast. Their
    rows then take part in the join under a name of their own that no value has, so they are spread
    over all tasks and no task gets a frequent value whole.
    """
    for column in columns:
        own = dictionary.where(F.col("column") == column)
        total = own.agg(F.sum("count")).first()[0] or 0
        own = own.select(F.col("value").alias("__value"), F.col("number").alias("__number"), "count")
        hot = own.where(F.col("count") * HOT_VALUES > total).drop("count")  # fewer than HOT_VALUES rows
        hot = F.broadcast(hot.withColumnsRenamed({"__value": "__hot_value", "__number": "__hot"}))
        df = df.join(hot, F.col(column) == F.col("__hot_value"), "left")
        spread = F.concat(F.lit("\x00"), F.xxhash64(key).cast("string"))
        asked = F.when(F.col("__hot").isNull() & F.col(column).isNotNull(), F.col(column)).otherwise(spread)
        df = df.withColumn("__asked", asked).join(own.drop("count"), F.col("__asked") == F.col("__value"), "left")
        df = df.withColumn(f"{column}_index", F.coalesce("__hot", "__number"))
        df = df.drop("__hot_value", "__hot", "__asked", "__value", "__number")
    return df


def category_domain(df: DataFrame, spec: TableSpec = CONTACTS) -> DataFrame:
    """``(column, value)``: the distinct known values of every categorical column."""
    return (
        value_counts(df, list(spec.categorical))
        .filter(F.col("value") != spec.missing_marker)
        .select("column", "value")
    )


def label_expression(spec: TableSpec = CONTACTS) -> Column:
    """1.0 for the positive class, 0.0 for any other, null for null.

    Pinned to the class name: numbering by frequency would swap the classes on a table where the
    positive one is the more frequent.
    """
    label = F.col(spec.label)
    return F.when(label.isNotNull(), (label == spec.positive).cast("double"))


def fit_features(
    df: DataFrame, spec: TableSpec = CONTACTS, handle_invalid: str = "error"
) -> PipelineModel:
    """Fit indexing, one-hot encoding, scaling and assembly on cleaned rows.

    Categories are numbered by falling frequency, ties alphabetically, in one job for all columns;
    the scaler takes one more. No stage touches the label, so unlabelled rows can be scored.
    ``handle_invalid`` says what an unseen category does: ``error``, ``skip`` or ``keep``.
    """
    encoded = [f"{c}_encoded" for c in spec.categorical]
    stages = [
        *category_stages(spec, handle_invalid), *scaling_stages(spec),
        VectorAssembler(inputCols=[*encoded, "scaled_features"], outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(df)


def category_stages(spec: TableSpec = CONTACTS, handle_invalid: str = "error") -> list:
    """Numbers and one-hot blocks of the categories."""
    categorical = list(spec.categorical)
    indexed = [f"{c}_index" for c in categorical]
    indexer = StringIndexer(
        inputCols=categorical, outputCols=indexed, handleInvalid=handle_invalid,
        stringOrderType="frequencyDesc",
    )
    encoded = [f"{c}_encoded" for c in categorical]
    return [indexer, OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True)]


def scaling_stages(spec: TableSpec = CONTACTS) -> list:
    return [
        VectorAssembler(inputCols=list(spec.numeric), outputCol="numeric_features"),
        StandardScaler(
            inputCol="numeric_features", outputCol="scaled_features", withMean=False, withStd=True
        ),
    ]


def known_values(
    df: DataFrame, model: PipelineModel, fill: dict[str, str], spec: TableSpec = CONTACTS
) -> DataFrame:
    """Replace categories the fitted model has never seen by the column's fill value.

    One unseen value would otherwise stop the whole job.
    """
    indexer = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    return df.withColumns({
        c: F.when(F.col(c).isin(*labels), F.col(c)).otherwise(fill.get(c, labels[0]))
        for c, labels in zip(spec.categorical, indexer.labelsArray)
    })


def feature_table(
    cleaned: DataFrame, model: PipelineModel, spec: TableSpec = CONTACTS
) -> DataFrame:
    """Cleaned rows with index, encoded, scaled and assembled columns, and ``label`` if known."""
    df = model.transform(cleaned)
    return df.withColumn("label", label_expression(spec)) if spec.label in cleaned.columns else df


def one_hot_positions(df: DataFrame, spec: TableSpec = CONTACTS) -> DataFrame:
    """Long form of the one-hot blocks: ``(key, column, position)`` of each 1."""
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.array_position(vector_to_array(f"{c}_encoded"), F.lit(1.0)).alias("slot"),
        )
        for c in spec.categorical
    ])
    return (
        df.select(spec.key, F.inline(entries))
        .filter("slot > 0")
        .select(spec.key, "column", (F.col("slot") - 1).cast("int").alias("position"))
    )


def vector_entries(df: DataFrame, key: str, vector: str = "features") -> DataFrame:
    """Long form of a vector column: ``(key, position, value)`` of the non-zero entries."""
    return (
        df.select(key, F.posexplode(vector_to_array(vector)).alias("position", "value"))
        .filter("value != 0")
    )
