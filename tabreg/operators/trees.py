"""Saved trees and forests as rows: their nodes and their leaves.

A fitted tree has at most 2^(depth + 1) nodes, which the driver holds in the
model anyway; the tables here are of that size. Training rows stay in Spark.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

_NODES = ("tree int, node int, path string, depth int, leaf int, feature string, threshold double, "
          "n_rows long, prediction double, impurity double, gain double")


def tree_nodes(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """One row per node of the tree or forest saved at ``path``.

    path spells the way from the root (``L``: the feature is at most the
    threshold); the root's is empty. leaf numbers a tree's leaves from left to
    right, as Spark's ``predictLeaf`` does. n_rows counts the training rows, or
    draws of rows, that reached the node. feature (its name in ``names``),
    threshold and gain are null for a leaf, leaf for an inner node. Splits on
    categorical features have no threshold and raise.
    """
    saved = spark.read.parquet(f"{path.rstrip('/')}/data")
    if "nodeData" in saved.columns:
        saved = saved.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        saved = saved.withColumn("tree", F.lit(0))
    by_tree: dict[int, dict[int, Row]] = {}
    for r in saved.select("tree", "id", "prediction", "impurity", "rawCount", "gain", "leftChild", "rightChild", "split").collect():
        by_tree.setdefault(r["tree"], {})[r["id"]] = r
    out = []
    for tree, nodes in sorted(by_tree.items()):
        leaves, todo = 0, [(0, "")]
        while todo:
            at, way = todo.pop()
            r = nodes[at]
            feature = threshold = gain = leaf = None
            if r["leftChild"] < 0:
                leaf, leaves = leaves, leaves + 1
            else:
                if r["split"]["numCategories"] != -1:
                    raise ValueError(f"node {at} of tree {tree} splits on categories, not on a threshold")
                feature, threshold = names[r["split"]["featureIndex"]], r["split"]["leftCategoriesOrThreshold"][0]
                gain = r["gain"]
                todo += [(r["rightChild"], way + "R"), (r["leftChild"], way + "L")]
            out.append((tree, at, way, len(way), leaf, feature, threshold, r["rawCount"], r["prediction"], r["impurity"], gain))
    return spark.createDataFrame(out, _NODES)


def leaf_means(model, rows: DataFrame, nodes: DataFrame, label: str) -> DataFrame:
    """(tree, path, n_draws, prediction, n_train, mean_train) of every leaf.

    ``rows`` are routed by the model itself, one leaf a tree; counts and sums
    are combined before the shuffle, so it carries leaves, not rows. A leaf
    that no row reaches has n_train 0 and a null mean.
    """
    at = f"leaf_{uuid.uuid4().hex[:12]}"
    routed = model.copy().setLeafCol(at).transform(rows)
    trees = F.transform(vector_to_array(F.col(at)), lambda x: x.cast("int"))
    reached = (routed.select(F.posexplode(trees).alias("tree", "leaf"), F.col(label).alias("_y"))
               .groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n_train"), F.avg("_y").alias("mean_train")))
    leaves = nodes.where("leaf is not null").select("tree", "leaf", "path", F.col("n_rows").alias("n_draws"), "prediction")
    return (leaves.join(F.broadcast(reached), ["tree", "leaf"], "left")
            .select("tree", "path", "n_draws", "prediction", F.coalesce("n_train", F.lit(0)).alias("n_train"), "mean_train"))
