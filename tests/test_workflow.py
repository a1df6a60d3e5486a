"""Leak tests and end-to-end runs."""

import pytest
from pyspark.sql import functions as F

from tabreg.operators import features
from tabreg.plans import workflow
from tabreg.plans.fixtures import KEYS
from tabreg.spec import FeatureSpec


def test_unseen_category_gets_keep_index(spark, fx):
    spec = FeatureSpec()
    prep = workflow.prepare(fx, spec)
    train = prep.where(F.col("FlightNum") != "1")
    test = prep.limit(5).withColumn("FlightNum", F.lit("never-seen"))
    model = features.fit_features(train, spec)
    n_labels = len(model.stages[1].labelsArray[spec.index_inputs.index("FlightNum")])
    got = {r[0] for r in model.transform(test).select("FlightNumIndex").collect()}
    assert got == {float(n_labels)}


def test_fill_means_come_from_training_rows(spark, fx):
    spec = FeatureSpec()
    prep = workflow.prepare(fx, spec)
    train = prep.where(F.col("l_linenumber") <= 3)
    model = features.fit_features(train, spec)
    surrogate = model.stages[0].surrogateDF.first().asDict()
    want = train.agg(F.avg("DepDelay")).first()[0]
    assert surrogate["DepDelay"] == pytest.approx(want, rel=1e-12)


def test_train_evaluate_small(spark, fx):
    ev = workflow.train_evaluate(fx, FeatureSpec(), model="dt", keys=KEYS,
                                 grid={"maxDepth": [2, 4]}, num_folds=2, estimator_params={"maxBins": 32})
    row = ev.metrics.first()
    assert row.model == "dt" and row.n_test > 1000 and 0 < row.r2 < 1
    import json
    chosen = json.loads(row.model_params)
    assert chosen["maxBins"] == 32 and chosen["maxDepth"] == json.loads(row.best_params)["maxDepth"]
    assert row.rmse ** 2 == pytest.approx(row.mse)
    assert row.orig_mse == row.mse
    ev.release()


def test_train_evaluate_cube_root_reports_both_units(spark, fx):
    ev = workflow.train_evaluate(fx, FeatureSpec(label="ArrDelayCubeRoot"), model="lr", keys=KEYS)
    row = ev.metrics.first()
    assert row.label == "ArrDelayCubeRoot" and row.mse < row.orig_mse
    assert row.cv_rmse > 0  # a single candidate is cross-validated too
    ev.release()


def test_cap_bounds_training_rows_only(spark, fx):
    rows = {}
    for cap in (1000, None):
        ev = workflow.train_evaluate(fx, FeatureSpec(), model="lr", keys=KEYS, max_rows=cap)
        rows[cap] = (ev.metrics.first().n_test, ev.train.count())
        ev.release()
    assert rows[1000][0] == rows[None][0] > 1000
    assert rows[1000][1] < 1200 < 4000 < rows[None][1]


def test_saved_model_is_reused(spark, fx):
    from tabreg.session import shared_dir
    root = shared_dir(spark, "t-models")
    runs = [workflow.train_evaluate(fx, FeatureSpec(), model="lr", keys=KEYS, model_dir=root, grid=g)
            for g in ({"regParam": [0.1, 5.0]}, {"regParam": [1.0]})]
    a, b = [ev.metrics.first() for ev in runs]
    assert (a.loaded, b.loaded) == (False, True) and b.cv_rmse != b.cv_rmse
    assert a.best_params == b.best_params and a.mse == pytest.approx(b.mse, rel=1e-12)
    other = workflow.train_evaluate(fx, FeatureSpec(label="ArrDelayCubeRoot"), model="lr", keys=KEYS, model_dir=root)
    assert not other.metrics.first().loaded  # another label has a folder of its own
    for ev in [*runs, other]:
        ev.release()


def test_default_split_does_not_depend_on_layout(spark, fx):
    def held_out(n):
        rows = workflow.assigned(fx.repartition(n), None).where(f"{workflow.SPLIT} = 'test'")
        return sorted(r[:] for r in rows.select(*KEYS, workflow.FOLD).collect())
    two = held_out(2)
    assert two == held_out(4) and 1000 < len(two) < 1400


def test_missing_feature_column_is_named(spark, fx):
    with pytest.raises(ValueError, match="TaxiOut"):
        workflow.train_evaluate(fx.drop("TaxiOut"), FeatureSpec(), model="lr", keys=KEYS)


def test_failed_search_frees_its_tables(spark, fx):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    with pytest.raises(Exception):
        workflow.train_evaluate(fx, FeatureSpec(), model="dt", keys=KEYS, grid={"maxDepth": [2, 31]}, num_folds=2)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_compare_models_rows(spark, fx):
    out = workflow.compare_models(fx, models=("lr",), keys=KEYS)
    rows = out.collect()
    assert len(rows) == 4
    assert {(r.time_mode, r.label) for r in rows} == {
        ("numeric", "ArrDelay"), ("numeric", "ArrDelayCubeRoot"),
        ("categorical", "ArrDelay"), ("categorical", "ArrDelayCubeRoot")}


def test_compare_models_two_models_both_modes(spark, fx):
    out = workflow.compare_models(fx, models=("lr", "dt"), labels=("ArrDelay",), keys=KEYS,
                                  grid={}, estimator_params=None)
    rows = out.collect()
    assert {(r.model, r.time_mode) for r in rows} == {("lr", "numeric"), ("lr", "categorical"),
                                                      ("dt", "numeric"), ("dt", "categorical")}
    assert all(r.n_test == rows[0].n_test for r in rows)  # one split for every combination


def test_train_evaluate_without_keys(spark, fx):
    ev = workflow.train_evaluate(fx, FeatureSpec(), model="lr")
    row = ev.metrics.first()
    assert 900 < row.n_test < 1500


def test_original_fill_mode(spark, fx):
    ev = workflow.train_evaluate(fx, FeatureSpec(), model="lr", keys=KEYS, fit_fill_on="all")
    assert ev.metrics.first().r2 > 0
    assert type(ev.model.stages[0]).__name__ == "StringIndexerModel"  # no fitted Imputer stage


def test_training_partitions():
    assert workflow.training_partitions(10) == 1
    assert workflow.training_partitions(120_000) == 3
    assert workflow.training_partitions(10**9) == 20_000  # by rows, whatever the cores


def test_materialized_inputs_chain(spark):
    from tabreg.plans.fixtures import flights
    from tabreg.session import shared_dir
    from tabreg.sources import io
    from conftest import SF0001
    csv = shared_dir(spark, "t-chain-csv")
    io.write_csv(flights(spark, SF0001, keep_keys=False), csv)
    root = shared_dir(spark, "t-chain")
    first = workflow.materialized_inputs(spark, csv, root, max_rows=3000)
    n = first.count()
    assert 2500 < n < 3300 and "DepTimeMin" in first.columns
    assert dict(first.dtypes)["ArrDelay"] == "double"
    # the same choice reads the written table; another cap or mode builds its own
    assert workflow.materialized_inputs(spark, csv, root, max_rows=3000).count() == n
    assert workflow.materialized_inputs(spark, csv, root, max_rows=300).count() < 500
    assert "DepTimeDisc" in workflow.materialized_inputs(spark, csv, root, FeatureSpec(time_mode="categorical"), max_rows=3000).columns


def test_unnormalised_features_give_categorical_splits(spark, fx):
    # Q15: without the L1 normaliser the indexers' nominal metadata reaches the tree
    ev = workflow.train_evaluate(fx, FeatureSpec(), model="dt", keys=KEYS, normalize=False,
                                 grid={}, estimator_params={"maxDepth": 4})
    tree = ev.model.stages[-1]
    assert ev.model.stages[-1].getFeaturesCol() == "features"
    assert " in {" in tree.toDebugString  # a split on a set of categories
    assert ev.metrics.first().r2 > 0


def test_comparison_cleans_the_raw_table_once_a_fold_number(spark, fx):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    raw = fx.where("l_linenumber <= 2")
    n = raw.count()
    spec = FeatureSpec(categorical=(), continuous=("TaxiOut",), clock=())
    out = workflow.compare_models(raw.mapInArrow(count, raw.schema), models=("lr",), time_modes=("numeric",), keys=KEYS, base=spec,
                                  normalize=False)
    assert out.count() == 2 and seen.value == n
