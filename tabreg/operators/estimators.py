"""Regressors (linear, decision tree, random forest) and scoring.

Defaults are the original application's settings. All three are Spark ML
estimators: linear regression with the normal-equation solver makes one
distributed pass that aggregates the p x p Gram matrix (p = 16 here); trees
make one pass per level over binned, cached instances. Neither ships rows
to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import (DecisionTreeRegressionModel, DecisionTreeRegressor,
                                   LinearRegression, LinearRegressionModel,
                                   RandomForestRegressionModel, RandomForestRegressor)
from pyspark.sql import DataFrame, SparkSession

from ..session import active_session, checkpoint_root, task_memory_mb
from .features import NORM_FEATURES

# --- fixed values: the original application's model settings ---------------
LR_DEFAULTS = dict(regParam=0.1, elasticNetParam=0.0, maxIter=100)
DT_DEFAULTS = dict(maxDepth=5, maxBins=7500)
RF_DEFAULTS = dict(numTrees=20, maxDepth=5, maxBins=7500)
# Grids searched by cross-validation, and folds.
GRIDS = {
    "lr": {"regParam": [0.1]},
    "dt": {"maxDepth": [5, 7, 9], "maxBins": [7500, 10000]},
    "rf": {},
}
FOLDS = {"lr": 2, "dt": 5, "rf": 5}
# ---------------------------------------------------------------------------

MODEL_CLASSES = {
    "lr": LinearRegressionModel,
    "dt": DecisionTreeRegressionModel,
    "rf": RandomForestRegressionModel,
}


def linear_regression(label: str, features: str = NORM_FEATURES, **params) -> LinearRegression:
    """Squared loss, L2 by default, standardised, with intercept."""
    return LinearRegression(labelCol=label, featuresCol=features, **{**LR_DEFAULTS, **params})


def _tree_params(params: dict, spark: SparkSession | None) -> dict:
    """Deep trees: cache node ids and checkpoint them.

    At depth >= 8 recomputing every row's node from the root each level
    dominates; cached node ids (checkpointed into the shared checkpoint
    folder every 10 levels) avoid that and keep lineage short.

    Split statistics stay at Spark's default 256 MB per task (maxMemoryInMB,
    also the original's setting): maxBins x features x 3 doubles per node is
    ~3 MB at 7500 bins and 16 features, so a pass holds ~90 nodes and deep
    levels take several passes. Raising it multiplies by every concurrent
    task on an executor and ran a 6 GB heap out of memory with 8 cores and
    three fits at once.
    """
    out = dict(params)
    if spark is not None and "maxMemoryInMB" not in out:
        out["maxMemoryInMB"] = tree_memory_mb(spark)
    if out.get("maxDepth", 5) >= 8:
        out.setdefault("cacheNodeIds", True)
        out.setdefault("checkpointInterval", 10)
        if spark is not None:
            checkpoint_root(spark)
    return out


def tree_memory_mb(spark: SparkSession, ceiling: int = 256, floor: int = 16) -> int:
    """Per-task budget for split statistics (``maxMemoryInMB``).

    Every task of a tree fit allocates up to this much for node histograms,
    and all tasks of a JVM run at once, so the budget is the JVM's heap
    share divided by its concurrent tasks: Spark's 256 MB with a 16 GB,
    8-core heap; 32 MB with the 1 GB default heap on 8 local cores (more,
    smaller passes instead of running out of memory). The value only
    changes how many nodes go in one pass, never the tree.
    """
    return int(max(floor, min(ceiling, task_memory_mb(spark))))


def decision_tree(label: str, features: str = NORM_FEATURES, spark: SparkSession | None = None,
                  **params) -> DecisionTreeRegressor:
    """Variance impurity; depth 5 and 7500 bins by default."""
    p = _tree_params({**DT_DEFAULTS, **params}, spark)
    return DecisionTreeRegressor(labelCol=label, featuresCol=features, **p)


def random_forest(label: str, features: str = NORM_FEATURES, spark: SparkSession | None = None,
                  **params) -> RandomForestRegressor:
    """20 trees, depth 5, 7500 bins by default."""
    p = _tree_params({**RF_DEFAULTS, **params}, spark)
    p.setdefault("seed", 1)
    return RandomForestRegressor(labelCol=label, featuresCol=features, **p)


def make_estimator(kind: str, label: str, features: str = NORM_FEATURES,
                   spark: SparkSession | None = None, **params):
    if kind == "lr":
        return linear_regression(label, features, **params)
    if kind == "dt":
        return decision_tree(label, features, spark=spark, **params)
    if kind == "rf":
        return random_forest(label, features, spark=spark, **params)
    raise ValueError(f"unknown model {kind!r}; expected one of lr, dt, rf")


def score(model, df: DataFrame) -> DataFrame:
    """Append ``prediction`` (a projection; no job runs)."""
    return model.transform(df)


def coefficients(model: LinearRegressionModel, names: Sequence[str]) -> DataFrame:
    """(term, coefficient) rows: one per feature, then ``(intercept)``."""
    spark = active_session()
    coefs = [float(v) for v in model.coefficients.toArray()]
    if len(coefs) != len(names):
        raise ValueError(f"model has {len(coefs)} coefficients but {len(names)} names were given")
    rows = list(zip(names, coefs)) + [("(intercept)", float(model.intercept))]
    return spark.createDataFrame(rows, "term string, coefficient double")


def chosen_params(model) -> dict:
    """The tree parameters a fitted model was trained with."""
    out = {}
    for name in ("maxDepth", "maxBins", "numTrees", "regParam", "elasticNetParam", "maxIter"):
        if model.hasParam(name) and model.isDefined(model.getParam(name)):
            out[name] = model.getOrDefault(model.getParam(name))
    if hasattr(model, "getNumTrees"):
        out["numTrees"] = model.getNumTrees
    return out
