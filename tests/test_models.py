"""Estimators against closed forms; summaries; save/load round trips."""

import math

import pytest
from pyspark.sql import functions as F

from tabreg.operators import estimators, features, metrics
from tabreg.plans import model_queries as MQ
from tabreg.session import shared_dir
from tabreg.sources import model_store
from conftest import SF0001


@pytest.fixture(scope="module")
def li(spark):
    return features.vector_assembler(["qx"]).transform(MQ._lineitem(spark, SF0001)).where("is_train").persist()


def _closed_form(li, lam):
    r = li.agg(F.covar_pop("y", "qx").alias("c"), F.var_pop("qx").alias("v"), F.stddev_pop("y").alias("sy"),
               F.avg("y").alias("my"), F.avg("qx").alias("mx")).first()
    slope = r.c / r.v / (1 + lam / r.sy)
    return slope, r.my - slope * r.mx


@pytest.mark.parametrize("lam", [0.0, 0.1, 1.0])
def test_ridge_one_feature_closed_form(li, lam):
    m = estimators.linear_regression("y", "features", regParam=lam).fit(li)
    slope, icpt = _closed_form(li, lam)
    assert m.coefficients[0] == pytest.approx(slope, rel=1e-9)
    assert m.intercept == pytest.approx(icpt, rel=1e-9)


def test_coefficient_stats_and_summary(li):
    m = estimators.linear_regression("y", "features", regParam=0.0, solver="normal").fit(li)
    stats = {r.term: r for r in metrics.coefficient_stats(m, ["qx"]).collect()}
    assert list(stats) == ["qx", "(intercept)"]  # intercept last, with its own numbers
    assert stats["(intercept)"].coefficient == pytest.approx(m.intercept)
    for r in stats.values():
        assert r.t_value * r.std_error == pytest.approx(r.coefficient, rel=1e-12)
        # large dof: two-sided t p-value ~ normal p-value
        assert r.p_value == pytest.approx(math.erfc(abs(r.t_value) / math.sqrt(2)), abs=2e-3)
    s = metrics.fit_summary(m, m.transform(li), "y").first()
    assert s.rmse ** 2 == pytest.approx(s.mse) and s.r2adj <= s.r2
    assert s.num_instances == li.count() and s.degrees_of_freedom == s.num_instances - 2
    assert s.r2 == pytest.approx(m.summary.r2, rel=1e-9)
    assert s.mae == pytest.approx(m.summary.meanAbsoluteError, rel=1e-9)
    assert s.explained_variance == pytest.approx(m.summary.explainedVariance, rel=1e-6)
    assert s.total_iterations == m.summary.totalIterations


def test_regression_metrics_equal_evaluator(li):
    from pyspark.ml.evaluation import RegressionEvaluator
    m = estimators.linear_regression("y", "features").fit(li)
    scored = m.transform(li)
    got = metrics.regression_metrics(scored, "y").first()
    for name in ("mse", "rmse", "r2", "mae"):
        ev = RegressionEvaluator(labelCol="y", metricName=name).evaluate(scored)
        assert getattr(got, name) == pytest.approx(ev, rel=1e-12)


def test_tree_group_means_and_roundtrip(spark):
    data = MQ._tree_data(spark, SF0001)
    train = data.where("is_train")
    model = MQ._dt(spark).fit(train)
    means = {r.lx: r.m for r in train.groupBy("lx").agg(F.avg("y").alias("m")).collect()}
    for r in model.transform(data).select("lx", "prediction").distinct().collect():
        assert r.prediction == pytest.approx(means[r.lx], rel=1e-12)
    # a tree's predictions sum to the label sum on its training rows
    s = model.transform(train).agg(F.sum("prediction"), F.sum("y")).first()
    assert s[0] == pytest.approx(s[1], rel=1e-12)
    path = model_store.save_model(model, shared_dir(spark, "t-dt"))
    loaded = model_store.load_model(estimators.MODEL_CLASSES["dt"], path)
    a = model.transform(data).select("prediction").collect()
    b = loaded.transform(data).select("prediction").collect()
    assert a == b


def test_load_or_train(spark, li):
    path = shared_dir(spark, "t-lr")
    calls = []

    def train():
        calls.append(1)
        return estimators.linear_regression("y", "features").fit(li)

    m1, loaded1 = model_store.load_or_train(path, estimators.MODEL_CLASSES["lr"], train)
    m2, loaded2 = model_store.load_or_train(path, estimators.MODEL_CLASSES["lr"], train)
    assert (loaded1, loaded2, len(calls)) == (False, True, 1)
    assert list(m1.coefficients) == list(m2.coefficients)


def test_forest_without_bootstrap_equals_group_means(spark):
    data = MQ._tree_data(spark, SF0001)
    train = data.where("is_train")
    rf = estimators.random_forest("y", "features", spark=spark, numTrees=3, maxDepth=6, maxBins=64,
                                  bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy="all")
    model = rf.fit(train)
    means = {r.lx: r.m for r in train.groupBy("lx").agg(F.avg("y").alias("m")).collect()}
    for r in model.transform(data).select("lx", "prediction").distinct().collect():
        assert r.prediction == pytest.approx(means[r.lx], rel=1e-12)


def test_unknown_model():
    with pytest.raises(ValueError):
        estimators.make_estimator("svm", "y")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_metrics_of_degenerate_rows(spark, ansi):
    """As Spark's evaluator: a constant label, one row, an exact prediction; no rows give nulls."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from tabreg.operators import metrics
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for rows in ([(2.0, 1.0), (2.0, 3.0)], [(2.0, 1.0)], [(2.0, 2.0), (2.0, 2.0)], [(1.0, 1.0), (3.0, 2.0)]):
            df = spark.createDataFrame(rows, "y double, prediction double")
            got = metrics.regression_metrics(df, "y", extra=True).first()
            for name in ("mse", "rmse", "r2", "mae"):
                want = RegressionEvaluator(labelCol="y", metricName=name).evaluate(df)
                assert got[name] == pytest.approx(want, nan_ok=True)
        empty = metrics.regression_metrics(spark.createDataFrame([], "y double, prediction double"), "y").first()
        assert empty.n == 0 and empty.rmse is None and empty.r2 is None
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
