"""Searches of several labels and models share a table's encoded rows, with the results of separate runs."""

import json

import pytest
from pyspark.sql import functions as F

from tabreg.operators import estimators, features, selection
from tabreg.plans import workflow
from tabreg.plans.fixtures import KEYS
from tabreg.session import shared_dir
from tabreg.sources import fs
from tabreg.spec import FeatureSpec

SPEC = FeatureSpec(categorical=("UniqueCarrier",), continuous=("TaxiOut", "DepDelay"), clock=("DepTime",))
GRIDS = {"lr": {"regParam": [0.1, 1.0]}, "dt": {"maxDepth": [1, 3]}, "rf": {}}
PARAMS = {"lr": {}, "dt": {"maxBins": 32}, "rf": {"maxBins": 32, "maxDepth": 2, "numTrees": 2}}


@pytest.fixture
def stages(monkeypatch):
    made, plain = [], features.feature_stages
    monkeypatch.setattr(features, "feature_stages", lambda spec, **kw: made.append(spec.time_mode) or plain(spec, **kw))
    return made


def test_comparison_encodes_a_fold_once_for_all_labels_and_models(spark, fx, stages):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    raw = fx.where("l_linenumber <= 3")
    n = raw.count()
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    out = workflow.compare_models(raw.mapInArrow(count, raw.schema), models=("lr", "rf"), keys=KEYS, base=SPEC,
                                  grid=GRIDS, estimator_params=PARAMS)
    assert out.count() == 8 and seen.value == n  # 2 and 5 folds, one cleaned table
    assert stages.count("numeric") == stages.count("categorical") == 2 + 5 + 1  # folds of lr, folds of rf, all training rows
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_comparison_equals_separate_runs(spark, fx):
    raw = fx.where("l_linenumber <= 3")
    run = dict(keys=KEYS, num_folds=2, grid=GRIDS, estimator_params=PARAMS)
    for got in workflow.compare_models(raw, base=SPEC, time_modes=("categorical",), **run).collect():
        ev = workflow.train_evaluate(raw, FeatureSpec(**{**SPEC.__dict__, "label": got.label, "time_mode": got.time_mode}), model=got.model, **run)
        want = ev.metrics.first()
        ev.release()
        assert got.best_params == want.best_params and got.n_test == want.n_test and json.loads(got.model_params)
        for c in ("cv_rmse", "mse", "r2", "mae", "orig_mse", "orig_r2"):
            assert got[c] == pytest.approx(want[c], rel=1e-9)


def test_broken_comparison_goes_on(spark, fx, monkeypatch):
    root, raw = shared_dir(spark, "t-models"), fx.where("l_linenumber <= 2")
    run = dict(models=("lr", "dt"), time_modes=("numeric",), keys=KEYS, base=SPEC, num_folds=2, grid=GRIDS, estimator_params=PARAMS, model_dir=root)
    plain, lost = selection.fit_best, []

    def fit_best(df, stages, est, *args, **kwargs):
        if est.getLabelCol() == "ArrDelay" and hasattr(est, "maxDepth"):
            lost.append(est)
            raise RuntimeError("lost")
        return plain(df, stages, est, *args, **kwargs)
    with monkeypatch.context() as m:
        m.setattr(selection, "fit_best", fit_best)
        with pytest.raises(RuntimeError, match="lost"):
            workflow.compare_models(raw, **run)
    assert lost and "dt-ArrDelay-numeric.search" in fs.children(spark, root)
    loaded = {(r.model, r.label): r.loaded for r in workflow.compare_models(raw, **run).collect()}
    assert len(loaded) == 4 and not loaded["dt", "ArrDelay"] and loaded["lr", "ArrDelayCubeRoot"]
    assert sorted(fs.children(spark, root)) == sorted(f"{m}-{c}-numeric" for m in ("lr", "dt") for c in ("ArrDelay", "ArrDelayCubeRoot"))


def test_searches_share_a_fold_and_rows_without_one_train_nothing(spark):
    rows = [(float(i % 5) + (0.5 if i % 3 else 0.0), float(i % 7), float(i % 5) if i % 11 else None, i % 3 if i % 10 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "y double, z double, x double, fold int")
    searches = [selection.Search(estimators.linear_regression(c, "features"), {"regParam": [0.1, 2.0]}, c) for c in ("y", "z")]
    searches.append(selection.Search(estimators.decision_tree("y", "features", spark=spark, maxBins=16), {"maxDepth": [1, 3]}, "y"))

    def stages():
        return [features.mean_imputer(["x"]), features.vector_assembler(["x"])]

    got = selection.cross_validate_all(df, stages, searches, "fold", 3)
    known = df.where(F.col("fold").isNotNull())
    for s, r in zip(searches, got):
        alone = selection.cross_validate_plain(known, stages, s.estimator, s.grid, s.label, "fold", 3)
        assert r.avg_metrics == pytest.approx(alone.avg_metrics, rel=1e-9) and r.best_index == alone.best_index
    with pytest.raises(ValueError, match="fold 2"):
        selection.cross_validate_all(df.where("fold = 2 or fold is null"), stages, searches, "fold", 3)
