"""Benchmark the headline stages at one scale factor; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_MEM (driver heap; default 60 % of physical memory, at most 16g),
BENCH_SKIP (comma list of stages).

Every stage forces full execution (``noop`` sink, a fit, or a one-row
aggregate). ``value`` is the sum of the headline stages; the original
application's forms of two stages (``CrossValidator`` over the whole
pipeline, four evaluator passes) are timed too and reported under
``reference_forms`` for comparison.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark import StorageLevel  # noqa: E402
from pyspark.ml.evaluation import RegressionEvaluator  # noqa: E402

from tabreg.operators import clean, estimators, features, metrics, selection  # noqa: E402
from tabreg.plans import fixtures, workflow  # noqa: E402
from tabreg.session import local_session  # noqa: E402
from tabreg.spec import SAMPLE_CAP, FeatureSpec  # noqa: E402

LR_GRID = {"regParam": [0.001, 0.01, 0.1, 0.5, 1.0, 2.0]}  # the original's wider LR grid
CV_FOLDS = 5


def _default_heap() -> str:
    """60 % of physical memory, between 2 and 16 GB (tree fits size their
    per-task buffers from this, so a small machine runs slower, not out of memory)."""
    try:
        phys_gb = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2**30
    except (ValueError, OSError, AttributeError):
        return "8g"
    return f"{max(2, min(16, int(phys_gb * 0.6)))}g"


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    skip = set(filter(None, os.environ.get("BENCH_SKIP", "").split(",")))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          memory=os.environ.get("BENCH_MEM") or _default_heap(), app="tabreg-bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    times: dict[str, float] = {}
    ref_forms: dict[str, float] = {}

    def timed(name, fn, into=times):
        if name in skip:
            return None
        t0 = time.perf_counter()
        out = fn()
        into[name] = round(time.perf_counter() - t0, 3)
        return out

    # warm-up: JVM start, first scan, codegen of the fixture projection
    fixtures.flights(spark, sf_dir).limit(1000).write.format("noop").mode("overwrite").save()

    spec = FeatureSpec()
    raw = fixtures.flights(spark, sf_dir)

    # 1. the original's cleaning chain (means over all rows), fully executed
    timed("preprocess", lambda: _noop(clean.preprocess(raw, spec)))

    # 2. split, leak-free cleaning, capped training rows checkpointed and cached for fitting
    data = workflow.prepare(workflow.assigned(raw, fixtures.KEYS, num_folds=CV_FOLDS), spec)
    train, n_train = timed("prepare_cache", lambda: workflow.training_table(data, [spec], SAMPLE_CAP))
    test = data.where(f"{workflow.SPLIT} = 'test'")

    # 3. feature encoding: fit on train (impute + 9-column index + assemble + L1), transform all
    def encode():
        model = features.fit_features(train, spec)
        tr = model.transform(train).persist(StorageLevel.MEMORY_AND_DISK)
        te = model.transform(test).persist(StorageLevel.MEMORY_AND_DISK)
        tr.count(), te.count()
        return model, tr, te
    _, tr, te = timed("feature_encoding", encode)

    # 4-6. the three regressors with the original's settings
    lr_model = timed("linear_regression", lambda: estimators.linear_regression(spec.label).fit(tr))
    timed("decision_tree", lambda: estimators.decision_tree(spec.label, spark=spark).fit(tr))
    timed("random_forest", lambda: estimators.random_forest(spec.label, spark=spark).fit(tr))

    # 7. metrics on held-out rows: one aggregate vs four evaluator passes
    scored = lr_model.transform(te)
    timed("regression_metrics", lambda: metrics.regression_metrics(scored, spec.label).first())
    timed("regression_metrics", lambda: [RegressionEvaluator(labelCol=spec.label, metricName=n).evaluate(scored)
                                         for n in ("mse", "rmse", "r2", "mae")], into=ref_forms)

    # 8. 6-candidate, 5-fold CV of the whole encoding + model: fold-level reuse vs CrossValidator
    est = estimators.linear_regression(spec.label)

    def stages():
        return features.feature_stages(spec)
    timed("cross_validate", lambda: selection.cross_validate(train, stages, est, LR_GRID, spec.label,
                                                             workflow.FOLD, CV_FOLDS, n_rows=n_train))
    timed("cross_validate", lambda: selection.cross_validate_plain(train, stages, est, LR_GRID, spec.label,
                                                                   workflow.FOLD, CV_FOLDS, parallelism=2),
          into=ref_forms)
    for d in (tr, te, train):
        d.unpersist()

    # 9-10. end to end from the raw table: split, clean, folds (2 for lr, 5 for dt), refit, score all held-out rows
    def run(model):
        ev = workflow.train_evaluate(raw, spec, model=model, keys=fixtures.KEYS)
        ev.metrics.first()
        ev.release()
    timed("train_evaluate_lr", lambda: run("lr"))
    timed("train_evaluate_dt", lambda: run("dt"))

    out = {"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "reference_forms": ref_forms, "sf": sf, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
