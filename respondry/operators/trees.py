"""A fitted forest as a table of its nodes, with scores and importances worked out from that table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from respondry.sources.models import save_model
from respondry.sources.workspace import new_path


def node_table(spark: SparkSession, model: RandomForestClassificationModel) -> DataFrame:
    """One row per node: ``tree``, ``node``, ``stats`` (rows per class), ``gain``, ``left``, ``right``, split.

    At most trees times 2 ** (depth + 1) rows, whatever the size of the training table.
    """
    saved = spark.read.parquet(save_model(model, new_path(spark, "forest")) + "/data")
    node = F.col("nodeData")
    return saved.select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["impurityStats"].alias("stats"),
        node["gain"].alias("gain"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        node["split"]["leftCategoriesOrThreshold"].alias("goes_left"),
        (node["split"]["numCategories"] == -1).alias("continuous"),
    )


def _packed(nodes: DataFrame) -> list[dict]:
    """The nodes of each tree as arrays by node number; see :func:`node_table` for their number."""
    held: dict = {}
    for r in nodes.collect():
        held.setdefault(r["tree"], {})[r["node"]] = r
    packed = []
    for rows in held.values():
        size = max(rows) + 1
        categories = [r["goes_left"] for r in rows.values() if r["left"] >= 0 and not r["continuous"]]
        tree = {
            "left": np.full(size, -1), "right": np.full(size, -1), "feature": np.zeros(size, int),
            "cut": np.full(size, np.nan), "share": np.full(size, np.nan),
            "sides": np.zeros((size, 1 + int(max((v for c in categories for v in c), default=0))), bool),
        }
        for n, r in rows.items():
            total = sum(r["stats"])
            tree["share"][n] = r["stats"][1] / total if total else np.nan
            if r["left"] < 0:
                continue
            tree["left"][n], tree["right"][n], tree["feature"][n] = r["left"], r["right"], r["feature"]
            if r["continuous"]:
                tree["cut"][n] = r["goes_left"][0]
            else:
                tree["sides"][n, [int(v) for v in r["goes_left"]]] = True
        packed.append(tree)
    return packed


def _walk(rows: np.ndarray, tree: dict, depth: int) -> np.ndarray:
    """The share of the positive class in the leaf that each row reaches."""
    at = np.zeros(len(rows), int)
    for _ in range(depth):
        inner = np.flatnonzero(tree["left"][at] >= 0)
        node = at[inner]
        value = rows[inner, tree["feature"][node]]
        slot = np.clip(np.nan_to_num(value), 0, tree["sides"].shape[1] - 1).astype(int)
        # a node has a cut or sides; a comparison with NaN is false
        low = (value <= tree["cut"][node]) | (tree["sides"][node, slot] & (slot == value))
        at[inner] = np.where(low, tree["left"][node], tree["right"][node])
    return tree["share"][at]


def with_walked_scores(scored: DataFrame, nodes: DataFrame, trees: int, depth: int, columns: list[str]) -> DataFrame:
    """``columns`` of every row and ``walked``: mean share of the positive class in the leaves it reaches.

    Row by row: the trees travel to the rows, which are not shuffled or multiplied.
    """
    shared = scored.sparkSession.sparkContext.broadcast(_packed(nodes))
    narrow = scored.select(*columns, vector_to_array("features").alias("__vec"))
    schema = T.StructType([*narrow.schema.fields[:-1], T.StructField("walked", T.DoubleType())])

    def walk(batches):
        for batch in batches:
            vectors = batch.column("__vec")
            walked = np.zeros(batch.num_rows)
            if batch.num_rows:
                rows = vectors.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                for tree in shared.value:
                    walked += _walk(rows, tree, depth)
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(walked / trees)], names=[*columns, "walked"])

    return narrow.mapInArrow(walk, schema)


def walked_scores(
    features: DataFrame, key: str, nodes: DataFrame, trees: int, depth: int
) -> DataFrame:
    """``(key, walked)``: :func:`with_walked_scores`, rows that share a key added up."""
    walked = with_walked_scores(features, nodes, trees, depth, [key])
    return walked.groupBy(key).agg(F.sum("walked").alias("walked"))


def gain_importance(nodes: DataFrame) -> DataFrame:
    """``(position, gained)``: gain times rows over the splits on a slot, trees weighing alike, summing to 1."""
    rows = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    splits = nodes.filter("left >= 0").select(
        "tree", F.col("feature").alias("position"), (F.col("gain") * rows).alias("gained")
    )
    totals = splits.groupBy("tree").agg(F.sum("gained").alias("total"))
    share = F.sum(F.try_divide("gained", "total")).alias("gained")
    shares = splits.join(F.broadcast(totals), "tree").groupBy("position").agg(share)
    whole = shares.agg(F.sum("gained")).first()[0] or 1.0
    return shares.select("position", (F.col("gained") / whole).alias("gained"))
