"""Random-forest fit, grid search and scoring."""

from __future__ import annotations

import math
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from respondry.functions import fixed_values as fv
from respondry.operators import forests
from respondry.operators.splitting import fold_number
from respondry.sources.workspace import exists, new_path, written

#: The most rows of a search in one share, folds together.
SHARE_ROWS = 500_000
#: Trees deeper than this keep the node a row has reached, instead of walking from the root on every level.
WALKED_DEPTH = 5


def forest(num_trees: int = 20, max_depth: int = 5, seed: int = fv.SEED) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="features", labelCol="label", seed=seed, numTrees=num_trees, maxDepth=max_depth,
        cacheNodeIds=max_depth > WALKED_DEPTH,
    )


def fit_forest(
    train: DataFrame, num_trees: int = 20, max_depth: int = 5, seed: int = fv.SEED,
    grown: forests.Grown | None = None,
) -> RandomForestClassificationModel:
    """A forest of ``train``, fitted by Spark or taken from the trees ``grown`` on it."""
    estimator = forest(num_trees, max_depth, seed)
    return grown.forest(estimator) if grown else estimator.fit(train.select("features", "label"))


def auc(scored: DataFrame) -> float:
    """Exact area under the ROC curve: no bins."""
    return BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="p_yes", metricName="areaUnderROC", numBins=0
    ).evaluate(scored)


def search_results(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out rows of a search in ``folder``: ``num_trees, max_depth, fold, row_key, label, p_yes``."""
    return spark.read.option("basePath", folder).parquet(f"{folder}/num_trees=*/max_depth=*/fold=*")


def in_shares(rows: DataFrame) -> DataFrame:
    """The same rows dealt round robin: shares of one size, as many in every round of tasks as there are cores.

    A fit waits for its largest task on every level of its trees.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores * max(1, math.ceil(rows.count() / (cores * SHARE_ROWS))))


def grid_search(
    train: DataFrame,
    key: str = "row_key",
    num_trees=fv.GRID_NUM_TREES,
    max_depths=fv.GRID_MAX_DEPTH,
    folds: int = fv.FOLDS,
    seed: int = fv.SEED,
    parallelism: int = 2,
    folder: str | None = None,
) -> tuple[RandomForestClassificationModel, DataFrame]:
    """Cross-validated search by AUC, then a refit of the best point on all rows.

    Folds come from the key's hash and are written as folder partitions, so leaving one out is a
    pruned scan, each in files of one size, so that the tasks of a fit are alike. The forests of a fold
    differ in size only and have their trees in common, so these are grown once (:mod:`.forests`). Every fit
    writes its held-out predictions to a part of ``folder`` (one of the
    application's own if none is named), and a search that is started again with the same folder and
    the same rows goes on after the parts it finds whole; see :func:`search_results`. Returns the model
    and one report row per grid point.
    """
    spark = train.sparkSession
    folder = folder or new_path(spark, "search")
    rows = in_shares(train.select(F.col(key).alias("row_key"), "features", "label"))
    folded = written(
        rows.withColumn("fold", fold_number(F.col("row_key"), folds, seed)), "folds", partition_by=("fold",)
    )
    grid = list(product(num_trees, max_depths))

    @inheritable_thread_target(spark)
    def one_fold(held_out):
        parts = {(t, d): f"{folder}/num_trees={t}/max_depth={d}/fold={held_out}" for t, d in grid}
        missing = [point for point, part in parts.items() if not exists(spark, f"{part}/_SUCCESS")]
        kept = folded.filter(F.col("fold") != held_out)
        if missing:
            grown = forests.Grown(kept, *map(max, zip(*missing)), seed)
        for trees, depth in missing:
            model = fit_forest(kept, trees, depth, seed, grown)
            scored = score(folded.filter(F.col("fold") == held_out), model)
            scored.select("row_key", "label", "p_yes").write.mode("overwrite").parquet(parts[trees, depth])
        return [auc(spark.read.parquet(part)) for part in parts.values()]

    with ThreadPool(max(1, parallelism)) as pool:
        values = list(zip(*pool.map(one_fold, range(folds), chunksize=1)))
    averages = [sum(areas) / folds for areas in values]
    best = averages.index(max(averages))
    report = spark.createDataFrame(
        [(t, d, a, i == best) for i, ((t, d), a) in enumerate(zip(grid, averages))],
        "num_trees int, max_depth int, avg_auc double, is_best boolean",
    )
    return fit_forest(folded, *grid[best], seed, forests.Grown(folded, *grid[best], seed)), report


def score(features: DataFrame, model: RandomForestClassificationModel) -> DataFrame:
    """Add raw prediction, probability, prediction and the plain ``p_yes``."""
    return model.transform(features).withColumn("p_yes", vector_to_array("probability")[1])
