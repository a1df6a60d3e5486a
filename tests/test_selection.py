"""Fold-level CV equals CrossValidator over the whole pipeline."""

import pytest

from tabreg.operators import estimators, features, selection
from tabreg.plans import workflow
from tabreg.plans.fixtures import KEYS
from tabreg.spec import FeatureSpec


def test_cv_reuse_equals_crossvalidator(spark, fx):
    spec = FeatureSpec()
    prep = workflow.prepare(fx, spec).withColumn("fold", __import__("tabreg.operators.sampling", fromlist=["x"])
                                                 .fold_column(KEYS, 3)).persist()
    est = estimators.linear_regression(spec.label)
    grid = {"regParam": [0.01, 0.1, 1.0]}

    def stages():
        return features.feature_stages(spec)

    a = selection.cross_validate(prep, stages, est, grid, spec.label, "fold", 3, parallelism=3)
    b = selection.cross_validate_plain(prep, stages, est, grid, spec.label, "fold", 3, parallelism=2)
    for x, y in zip(a.avg_metrics, b.avg_metrics):
        assert x == pytest.approx(y, rel=1e-9)
    assert a.best_index == b.best_index
    frame = a.to_frame(spark).orderBy("candidate").collect()
    assert [r.regParam for r in frame] == [0.01, 0.1, 1.0] and sum(r.is_best for r in frame) == 1


def test_empty_grid_is_one_candidate(spark):
    est = estimators.random_forest("y")
    assert len(selection.param_grid(est, {})) == 1


def test_shallow_trees_are_read_off_the_deepest(spark, fx):
    from tabreg.operators import sampling
    spec = FeatureSpec()
    prep = workflow.prepare(fx, spec).withColumn("fold", sampling.fold_column(KEYS, 2)).persist()
    est = estimators.decision_tree(spec.label, spark=spark)
    grid = {"maxDepth": [2, 4, 6, 0], "maxBins": [500, 900]}

    def stages():
        return features.feature_stages(spec)

    a = selection.cross_validate(prep, stages, est, grid, spec.label, "fold", 2)
    assert len(selection._nested(est, selection.param_grid(est, grid))) == 2
    for i, pm in enumerate(selection.param_grid(est, grid)):
        one = {p.name: [v] for p, v in pm.items()}
        b = selection.cross_validate(prep, stages, est, one, spec.label, "fold", 2)
        assert a.fold_metrics[i] == pytest.approx(b.fold_metrics[0], rel=1e-9)
    prep.unpersist()


def test_fold_without_rows_does_not_end_the_search(spark):
    df = spark.createDataFrame([(float(i), float(i % 3), i % 2) for i in range(40)], "y double, x double, fold int")
    est = estimators.linear_regression("y", "features")

    def stages():
        return [features.vector_assembler(["x"])]

    got = selection.cross_validate(df, stages, est, {"regParam": [0.1, 1.0]}, "y", "fold", 3)  # fold 2 is empty
    assert got.fold_metrics[0][2] is None and got.avg_metrics[0] > 0
    with pytest.raises(ValueError, match="fold 0"):
        selection.cross_validate(df.where("fold = 0"), stages, est, {"regParam": [0.1]}, "y", "fold", 1)


def test_layout_follows_rows_not_cores():
    assert selection.fit_layout(10**9, 20_000, 8, 30) == (1, 5000)
    assert selection.fit_layout(10**9, 20_000, 10_000, 30) == (2, 5000)
    assert selection.fit_layout(375_000, 10, 8, 10) == (4, 2)
    assert selection.fit_layout(1000, 1, 2000, 30) == (30, 1)
