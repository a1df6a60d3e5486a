"""End-to-end: split -> clean -> cross-validate -> refit -> score held-out rows.

``train_evaluate`` is the original application's run for one model choice;
``compare_models`` runs every (time mode, label, model) combination the
original compared by editing constants and re-running, as one job list
returning one row per combination.

Leak-free by default: fill means, category order and the model are fitted on
training rows only and saved together as one ``PipelineModel``; the split
and the folds are keyed hashes (of all columns, unless keys are given), so
the same rows are held out on every run. The sample cap bounds training rows
only: every held-out row is scored. ``fit_fill_on="all"`` takes the means of
all rows, as the original did.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clean, estimators, features, metrics, sampling, selection
from ..operators.selection import CVResult
from ..session import checkpoint_root
from ..sources import fs, io, model_store, scratch
from ..spec import LABEL, LABEL_CUBE_ROOT, SAMPLE_CAP, SAMPLE_SEED, FeatureSpec

FOLD = "__fold"
SPLIT = "__split"
#: ``keys`` value for seeded per-row draws, which depend on the table's layout.
RAND = "rand"


@dataclass
class Evaluation:
    metrics: DataFrame          # one row
    model: PipelineModel        # features + fitted regressor
    cv: CVResult | None         # None for a loaded model
    test_scored: DataFrame      # held-out rows with ``prediction``
    train: DataFrame | None = None

    def release(self) -> None:
        """Drop the cached training table (results stay computable from the source)."""
        if self.train is not None and self.train.is_cached:
            self.train.unpersist()


def prepare(raw: DataFrame, spec: FeatureSpec, fit_fill_on: str = "train") -> DataFrame:
    """Clean a raw flight table for modelling.

    With ``fit_fill_on="train"`` numeric gaps stay null here and a fitted
    Imputer fills them from training rows; derived day parts get the
    constant fill (a stateless rule, safe before the split).
    """
    if fit_fill_on not in ("train", "all"):
        raise ValueError("fit_fill_on must be 'train' or 'all'")
    out = clean.preprocess(raw, spec, impute_means_from="all" if fit_fill_on == "all" else "none")
    if spec.time_mode == "categorical":
        out = clean.constant_impute(out, spec.derived_clock)
    elif fit_fill_on == "all":
        # The original left <c>Min unfilled, which NaN-poisons whole rows
        # after L1 normalisation; fill them from the means of all labelled rows.
        out = clean.mean_impute(out, spec.derived_clock)
    return out


ROWS_PER_PARTITION = 50_000


def prepare_modes(raw: DataFrame, base: FeatureSpec, time_modes: Sequence[str],
                  fit_fill_on: str = "train") -> DataFrame:
    """One cleaned table carrying the clock features of every requested mode.

    The modes differ only in derived columns, so one scan, one shuffle and
    one cached copy serve all of them; each spec reads its own columns.
    """
    base = replace(base, label=base.raw_label)
    out = prepare(raw, replace(base, time_mode=time_modes[0]), fit_fill_on)
    for mode in time_modes[1:]:
        other = replace(base, time_mode=mode)
        out = clean.add_clock_features(out, other.clock, mode)
        if mode == "categorical":
            out = clean.constant_impute(out, other.derived_clock)
        elif fit_fill_on == "all":
            out = clean.mean_impute(out, other.derived_clock)
    return out


def assigned(raw: DataFrame, keys: Sequence[str] | str | None, train_percent: int = 80,
             num_folds: int | Mapping[str, int] = 5, seed: int = 1) -> DataFrame:
    """``raw`` with its side of the split and its fold.

    By default both are hashes of all columns, so equal rows stay together and
    neither layout nor retries move a row; ``keys`` names the columns to hash,
    ``RAND`` asks for seeded draws per row. ``num_folds`` may map the names of
    several fold columns to their numbers of folds.
    """
    folds = num_folds if isinstance(num_folds, Mapping) else {FOLD: num_folds}
    if keys == RAND:
        return raw.withColumns({
            SPLIT: F.when(F.rand(seed) < F.lit(train_percent / 100.0), F.lit("train")).otherwise(F.lit("test")),
            **{c: F.floor(F.rand(seed + 1) * F.lit(k)).cast("int") for c, k in folds.items()}})
    keys = list(keys) if keys else raw.columns
    return raw.withColumns({SPLIT: sampling.split_column(keys, train_percent),
                            **{c: sampling.fold_column(keys, k) for c, k in folds.items()}})


ROWS_PER_PARTITION = 50_000


def training_partitions(n_rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    """Partitions for a table that models are fitted on: by its rows alone, 50k each.

    ``selection.fit_layout`` narrows them further for tree fits.
    """
    return max(1, math.ceil(n_rows / rows_per_partition))


def _inputs(specs: Sequence[FeatureSpec]) -> list[str]:
    """Labels and feature inputs of the specs."""
    return list(dict.fromkeys([LABEL_CUBE_ROOT, *(c for s in specs for c in (s.raw_label, s.label, *s.index_inputs, *s.numeric_inputs))]))


def training_table(prepared: DataFrame, specs: Sequence[FeatureSpec], max_rows: int | None = SAMPLE_CAP,
                   sample_keys: Sequence[str] | None = None, seed: int = SAMPLE_SEED,
                   folds: Sequence[str] = (FOLD,)) -> tuple[DataFrame, int]:
    """(training rows of a prepared table, how many about): sampled, pruned, checkpointed, persisted.

    ``max_rows`` is the original's cap (1.5 M rows), here a bound on labelled
    training rows: per-row Bernoulli with the original's seed, so a hot key
    can't pass it; ``sample_keys`` makes it a keyed hash. Only the labels, the
    specs' feature inputs and the ``folds`` are kept. The reliable checkpoint
    (under ``spark.checkpoint.dir``) cuts the lineage, so an executor lost
    during a long search never rescans the input.
    """
    checkpoint_root(prepared.sparkSession)
    wanted = [*_inputs(specs), *folds]
    train = prepared.where(F.col(SPLIT) == "train").select(*wanted)
    n = train.count()
    if max_rows is not None:
        train = sampling.bounded_sample(train if not sample_keys else prepared.where(F.col(SPLIT) == "train"),
                                        max_rows=max_rows, keys=sample_keys, seed=seed, n_rows=n).select(*wanted)
        n = min(n, max_rows)
    table = train.repartition(training_partitions(n)).checkpoint(eager=True)
    return table.persist(StorageLevel.MEMORY_AND_DISK), n


def materialized_inputs(spark, csv_path: str, root: str, spec: FeatureSpec = FeatureSpec(),
                        max_rows: int | None = SAMPLE_CAP, seed: int = SAMPLE_SEED) -> DataFrame:
    """The original's read-through chain, ending in a typed Parquet table.

    Use ``<root>/merged_processed_dataset-...`` if it exists; else build it from
    ``<root>/merged_dataset-...`` (cleaning chain, means over all rows); else
    build that from the raw CSV (bounded Bernoulli sample, seed 1234). The
    names hold the source, cap and seed, and the cleaned table's also the
    spec, so another choice never finds this one's table; a stamp of the CSV
    files makes new or changed files rebuild both. Each level is
    written once and read back. Unlike the original, the cleaned table is
    written too, so a rerun skips cleaning.
    """
    def short(x) -> str:
        return hashlib.md5(repr(x).encode()).hexdigest()[:8]

    sample = f"{short(csv_path)}-{'all' if max_rows is None else max_rows}-{seed}"

    inputs = [csv_path]

    def merged():
        raw = io.read_raw(spark, csv_path)
        if max_rows is None:
            return raw
        return sampling.bounded_sample(raw, max_rows=max_rows, seed=seed)

    def processed():
        return clean.preprocess(io.read_or_build(spark, f"{root}/merged_dataset-{sample}", merged, inputs), spec)

    return io.read_or_build(spark, f"{root}/merged_processed_dataset-{sample}-{spec.tag}-{short(spec)}", processed, inputs)


def _for_model(choice, model: str):
    """``choice`` itself, or its entry for the model if it maps model names."""
    if isinstance(choice, Mapping) and choice and all(isinstance(v, Mapping) for v in choice.values()):
        return choice.get(model)
    return choice


@dataclass
class _Run:
    """One model choice for one label: what to search and, later, what was found."""
    spec: FeatureSpec
    model: str
    estimator: object
    grid: dict
    num_folds: int
    path: str | None            # of the saved model
    cv: CVResult | None = None
    fitted: PipelineModel | None = None
    loaded: bool = False

    def metrics(self, scored: DataFrame) -> DataFrame:
        """One row: the held-out rows' metrics and the run's parameters."""
        spec, label, cv = self.spec, self.spec.label, self.cv
        if label == LABEL_CUBE_ROOT:
            # Also report in the original label's units (prediction cubed).
            orig_pair = (spec.raw_label, "__back")
            scored_m = scored.withColumn("__back", F.pow(F.col("prediction"), F.lit(3.0)))
        else:
            orig_pair, scored_m = (label, "prediction"), scored
        m = metrics.regression_metrics_sets(scored_m, {"": (label, "prediction"), "orig_": orig_pair})
        chosen = estimators.chosen_params(self.fitted.stages[-1])
        best = {name: v.item() if hasattr(v, "item") else v for name, v in cv.best_params.items()} if cv else {
            name: chosen[name] for name in self.grid if name in chosen}
        return m.select(
            F.lit(self.model).alias("model"), F.lit(label).alias("label"),
            F.lit(spec.time_mode).alias("time_mode"),
            F.lit(json.dumps(best, sort_keys=True)).alias("best_params"),
            F.lit(json.dumps(chosen, sort_keys=True)).alias("model_params"),
            F.lit(float(cv.avg_metrics[cv.best_index]) if cv else float("nan")).alias("cv_rmse"),
            F.lit(self.loaded).alias("loaded"),
            F.col("n").alias("n_test"), "mse", "rmse", "r2", "mae",
            "orig_mse", "orig_rmse", "orig_r2", "orig_mae",
        )


def _fit_runs(train: DataFrame, n_train: int, choices: Sequence[tuple[FeatureSpec, str]], fold_columns: Mapping[int, str],
              grid: dict | None = None, num_folds: int | None = None, parallelism: int | None = None,
              fit_fill_on: str = "train", normalize: bool = True, estimator_params: dict | None = None,
              model_dir: str | None = None) -> tuple[list[_Run], PipelineModel | None]:
    """(a fitted run for each choice, the feature stages of those not loaded); the specs differ in their label only.

    The runs share the encoded rows: those of a fold serve the searches of all
    labels and models with that number of folds, those of the whole table all
    refits.
    """
    spark, runs = train.sparkSession, []
    for spec, model in choices:
        own = _for_model(grid, model)
        est = estimators.make_estimator(model, spec.label, features.features_col(normalize), spark=spark,
                                        **(_for_model(estimator_params, model) or {}))
        runs.append(_Run(spec, model, est, estimators.GRIDS[model] if own is None else own,
                         estimators.FOLDS[model] if num_folds is None else num_folds,
                         model_store.model_path(model_dir, model, spec.label, spec.time_mode) if model_dir else None))

    def stages():
        return features.feature_stages(choices[0][0], impute=(fit_fill_on == "train"), normalize=normalize)

    def store(run: _Run, fit: Callable[[], PipelineModel]) -> None:
        if not run.path:
            run.fitted = fit()
            return
        run.fitted, run.loaded = model_store.load_or_train(run.path, PipelineModel, fit)
        run.cv = None if run.loaded else run.cv
        fs.remove(spark, f"{run.path}.search")

    def not_there():
        raise RuntimeError("a saved model went away while it was loaded")

    todo = []
    for run in runs:
        if run.path and fs.exists(spark, run.path):
            store(run, not_there)
        else:
            todo.append(run)
    if not todo:
        return runs, None
    for k in sorted({run.num_folds for run in todo}):
        group = [run for run in todo if run.num_folds == k]
        found = selection.cross_validate_all(
            train, stages, [selection.Search(r.estimator, r.grid, r.spec.label, f"{r.path}.search" if r.path else None) for r in group],
            fold_columns[k], k, parallelism=parallelism, n_rows=n_train)
        for run, run.cv in zip(group, found):
            pass
    whole = train.drop(*fold_columns.values())
    at_once, _ = selection.fits_at_once(whole, n_train, len(todo), parallelism)
    with selection.encoded(whole, stages, [*(r.spec.label for r in todo), features.features_col(normalize)], n_train) as given, \
            ThreadPoolExecutor(max_workers=at_once) as pool:
        for job in [pool.submit(store, run, lambda run=run: selection.fit_best(whole, stages, run.estimator, run.cv.best_params, given))
                    for run in todo]:
            job.result()
    return runs, given[0]


def evaluate(train: DataFrame, n_train: int, test: DataFrame, spec: FeatureSpec, model: str = "dt",
             num_folds: int | None = None, **kwargs) -> Evaluation:
    """Cross-validate on ``train``, refit, and score every row of ``test``.

    ``kwargs`` are those of ``_fit_runs``. With ``model_dir`` a model saved there
    for this model, label and mode is loaded and only scored (``loaded`` is true,
    ``cv_rmse`` NaN); else the fitted one is saved there. Until it is, the metrics
    of finished fits lie beside it (``<model>.search``), and a run that broke off
    goes on from them.
    """
    k = _folds_of([model], num_folds)[model]
    (run,), _ = _fit_runs(train, n_train, [(spec, model)], {k: FOLD}, num_folds=k, **kwargs)
    scored = run.fitted.transform(test)
    return Evaluation(run.metrics(scored), run.fitted, run.cv, scored, train)


@contextmanager
def _held_out(feats: PipelineModel | None, test: DataFrame, labels: Sequence[str], normalize: bool) -> Iterator[DataFrame | None]:
    """The held-out rows as the models read them, kept (memory and disk) until all are scored; None without feature stages."""
    if feats is None:
        yield None
        return
    rows = feats.transform(test).select(*dict.fromkeys([*labels, features.features_col(normalize)])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def _folds_of(models: Sequence[str], num_folds: int | None) -> dict[str, int]:
    return {m: estimators.FOLDS[m] if num_folds is None else num_folds for m in models}


def train_evaluate(raw: DataFrame, spec: FeatureSpec = FeatureSpec(), model: str = "dt",
                   keys: Sequence[str] | str | None = None, fit_fill_on: str = "train",
                   max_rows: int | None = SAMPLE_CAP, sample_keys: Sequence[str] | None = None,
                   num_folds: int | None = None, train_percent: int = 80, seed: int = 1, **kwargs) -> Evaluation:
    """Split, clean and evaluate one model (the original's default: dt).

    ``max_rows`` bounds the training rows, ``None`` trains on all of them;
    the held-out rows are all scored, whatever it is.
    """
    k = _folds_of([model], num_folds)[model]
    prepared = prepare(assigned(raw, keys, train_percent, k, seed), spec, fit_fill_on)
    train, n = training_table(prepared, [spec], max_rows, sample_keys)
    test = prepared.where(F.col(SPLIT) == "test").drop(SPLIT, FOLD)
    try:
        return evaluate(train, n, test, spec, model=model, num_folds=k, fit_fill_on=fit_fill_on, **kwargs)
    except BaseException:
        train.unpersist()
        raise


def compare_models(raw: DataFrame, models: Sequence[str] = ("lr", "dt", "rf"),
                   time_modes: Sequence[str] = ("numeric", "categorical"),
                   labels: Sequence[str] = (LABEL, LABEL_CUBE_ROOT),
                   keys: Sequence[str] | str | None = None, fit_fill_on: str = "train",
                   base: FeatureSpec = FeatureSpec(), max_rows: int | None = SAMPLE_CAP,
                   sample_keys: Sequence[str] | None = None, num_folds: int | None = None,
                   train_percent: int = 80, seed: int = 1, **kwargs) -> DataFrame:
    """One metrics row per (time mode, label, model) combination, each model with its own grid and folds.

    One cleaned table (clock features of every mode, a fold column for each
    number of folds) is written, and its training rows are persisted; all
    combinations share them. The combinations of a time mode also share the
    encoded rows of each fold, of the whole table and of the held-out side.
    ``grid`` and ``estimator_params`` may map model names to their own.
    """
    spark, normalize = raw.sparkSession, kwargs.get("normalize", True)
    rows, schema = {}, None
    specs = {(mode, label): replace(base, label=label, time_mode=mode) for mode in time_modes for label in labels}
    folds = _folds_of(models, num_folds)
    columns = {k: f"{FOLD}{k}" for k in sorted(set(folds.values()))}
    inputs = dict.fromkeys([*_inputs(list(specs.values())), *(sample_keys or []), SPLIT, *columns.values()])
    with scratch.Scratch(spark, "comparison") as run:
        # written once: else the count, the training table and every model's scoring would each clean the raw table anew
        prepared = run.cut(prepare_modes(assigned(raw, keys, train_percent, {c: k for k, c in columns.items()}, seed),
                                         base, list(time_modes), fit_fill_on).select(*inputs), "prepared")
        train, n = training_table(prepared, list(specs.values()), max_rows, sample_keys, folds=list(columns.values()))
        test = prepared.where(F.col(SPLIT) == "test").drop(SPLIT, *columns.values())
        try:
            for mode in time_modes:
                choices = [(specs[mode, label], model) for label in labels for model in models]
                found, feats = _fit_runs(train, n, choices, columns, num_folds=num_folds, fit_fill_on=fit_fill_on, **kwargs)
                with _held_out(feats, test, [c for s, _ in choices for c in (s.raw_label, s.label)], normalize) as encoded:
                    for r in found:
                        scored = r.fitted.transform(test) if r.loaded else r.fitted.stages[-1].transform(encoded)
                        # One aggregate row per combination, computed while the tables are cached.
                        out = r.metrics(scored)
                        rows[mode, r.spec.label, r.model], schema = out.first(), out.schema
        finally:
            train.unpersist()
    return spark.createDataFrame([rows[mode, label, m] for k in columns for mode, label in specs for m in models if folds[m] == k], schema)
