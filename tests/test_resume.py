"""A search that broke off goes on from its finished fits, and only for the same search."""

import pytest
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from tabreg.operators import estimators, features, selection
from tabreg.plans import workflow
from tabreg.plans.fixtures import KEYS
from tabreg.session import shared_dir
from tabreg.sources import fs
from tabreg.spec import FeatureSpec

GRID = {"regParam": [0.1, 0.5, 2.0]}
ONE = {"regParam": [0.1]}


class Counter:
    """Counts the fits of an estimator class and breaks off at one of them."""

    def __init__(self, monkeypatch, cls, stop=None):
        self.n, plain = 0, cls.fit

        def fit(est, *args, **kwargs):
            self.n += 1
            if stop is not None and self.n > stop:
                raise RuntimeError("lost")
            return plain(est, *args, **kwargs)
        monkeypatch.setattr(cls, "fit", fit)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(float(i * 7 % 23) + i % 3, float(i % 23), i % 4, i) for i in range(200)],
                                 "y double, x double, fold int, id int")


def _search(df, progress, grid=GRID, est=None, folds=4, **kwargs):
    est = est or estimators.linear_regression("y", "features")
    return selection.cross_validate(df, lambda: [features.vector_assembler(["x"])], est, grid, "y", "fold", folds,
                                    parallelism=1, progress=progress, **kwargs)


def _fits(spark, root):
    return sum(n.startswith("fit-") for run in fs.children(spark, root) for n in fs.children(spark, f"{root}/{run}"))


def test_goes_on_after_two_folds(spark, rows, monkeypatch):
    root = shared_dir(spark, "t-progress")
    want = _search(rows, None)
    with monkeypatch.context() as m:
        first = Counter(m, LinearRegression, stop=6)
        with pytest.raises(RuntimeError, match="lost"):
            _search(rows, root)
    kept = _fits(spark, root)
    assert first.n > 6 and kept == 6
    with monkeypatch.context() as m:
        second = Counter(m, LinearRegression)
        got = _search(rows.repartition(3), root)  # another layout of the same rows
    assert second.n == 12 - kept and got.fold_metrics == [pytest.approx(x, rel=1e-9) for x in want.fold_metrics]
    assert got.best_params == want.best_params
    with monkeypatch.context() as m:
        third = Counter(m, LinearRegression)
        again = _search(rows, root)
        more = _search(rows, root, {"regParam": [0.1, 9.0]})
    assert third.n == 4 and again.fold_metrics == got.fold_metrics and more.fold_metrics[0] == got.fold_metrics[0]


def test_other_searches_start_anew(spark, rows, monkeypatch):
    root = shared_dir(spark, "t-progress")
    _search(rows, root, ONE, folds=2)
    with monkeypatch.context() as m:
        count = Counter(m, LinearRegression)
        _search(rows.withColumn("y", F.when(F.col("id") == 3, 0.5).otherwise(F.col("y"))), root, ONE, folds=2)  # one changed value
        _search(rows.union(rows.where("id = 1")), root, ONE, folds=2)  # a repeated row
        _search(rows, root, ONE, folds=2, est=estimators.linear_regression("y", "features", fitIntercept=False))
        _search(rows, root, ONE, folds=2, metric="mae")
    assert count.n == 8


def test_nested_depths_and_empty_fold(spark, rows, monkeypatch):
    root, grid = shared_dir(spark, "t-progress"), {"maxDepth": [1, 3], "maxBins": [16, 32]}
    est = estimators.decision_tree("y", "features", spark=spark)
    want = _search(rows, root, grid, est, folds=5)  # fold 4 has no rows to score
    assert want.fold_metrics[0][4] is None
    with monkeypatch.context() as m:
        count = Counter(m, DecisionTreeRegressor)
        got = _search(rows, root, grid, est, folds=5)
    assert count.n == 0 and got.fold_metrics == want.fold_metrics


def test_workflow_goes_on_and_removes_the_rows(spark, fx, monkeypatch):
    root = shared_dir(spark, "t-models")
    run = dict(model="lr", keys=KEYS, model_dir=root, grid={"regParam": [0.1, 5.0]}, num_folds=2)

    def lost(*args, **kwargs):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(selection, "fit_best", lost)
        with pytest.raises(RuntimeError, match="lost"):
            workflow.train_evaluate(fx, FeatureSpec(), **run)
    search = next(n for n in fs.children(spark, root) if n.endswith(".search"))
    assert _fits(spark, f"{root}/{search}") == 4
    with monkeypatch.context() as m:
        # one Pipeline.fit a fold's features and one for the model of the whole table
        count = Counter(m, LinearRegression)
        ev = workflow.train_evaluate(fx, FeatureSpec(), **run)
    assert count.n == 1 and not ev.metrics.first().loaded and ev.cv.avg_metrics[0] > 0
    assert not any(n.endswith(".search") for n in fs.children(spark, root))
    ev.release()
