"""Parameter grids and k-fold cross-validation with fold-level feature reuse.

``CrossValidator`` over a whole pipeline refits the feature stages for every
(candidate, fold) pair. Here each fold fits the feature stages once on its
training rows, keeps the transformed rows (memory and disk), and fits every
candidate on them, several at a time from a small driver thread pool. The
metrics equal those of ``CrossValidator(Pipeline(features + model),
foldCol=...)``: the feature stages do not depend on the model's parameters.
Nor do they on the label or the estimator, so the searches of several labels
and estimators share a fold's rows (``cross_validate_all``).

Folds come from a fold column (a keyed hash by default), so the same rows
land in the same fold on every run and after any executor loss.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from threading import Semaphore

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir
from ..sources import fs
from .metrics import regression_metrics, regression_metrics_sets


def param_grid(estimator, grid: dict[str, Sequence]) -> list[dict]:
    """All combinations of the grid as ParamMaps (an empty grid gives one empty map)."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


@dataclass
class CVResult:
    grid_names: list[str]
    param_maps: list[dict]
    fold_metrics: list[list[float | None]]  # [candidate][fold]; None: the fold had no rows
    metric: str

    @property
    def avg_metrics(self) -> list[float]:
        """Means over the folds that had rows to score."""
        return [sum(m) / len(m) for m in ([v for v in ms if v is not None] for ms in self.fold_metrics)]

    @property
    def best_index(self) -> int:
        avgs = self.avg_metrics
        if self.metric == "r2":
            return max(range(len(avgs)), key=avgs.__getitem__)
        return min(range(len(avgs)), key=avgs.__getitem__)

    @property
    def best_params(self) -> dict:
        return {p.name: v for p, v in self.param_maps[self.best_index].items()}

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """(candidate, <grid params>, avg_<metric>, is_best) rows."""
        best = self.best_index
        fields = [T.StructField("candidate", T.IntegerType())]
        rows_params = []
        for pm in self.param_maps:
            by_name = {p.name: v for p, v in pm.items()}
            rows_params.append([by_name.get(n) for n in self.grid_names])
        for j, n in enumerate(self.grid_names):
            vals = [r[j] for r in rows_params]
            is_int = all(isinstance(v, int) and not isinstance(v, bool) for v in vals)
            fields.append(T.StructField(n, T.IntegerType() if is_int else T.DoubleType()))
        fields += [T.StructField(f"avg_{self.metric}", T.DoubleType()),
                   T.StructField("is_best", T.BooleanType())]
        rows = [tuple([i] + [v if isinstance(v, int) else float(v) for v in rows_params[i]]
                      + [float(self.avg_metrics[i]), i == best])
                for i in range(len(self.param_maps))]
        return spark.createDataFrame(rows, T.StructType(fields))


def _metric_values(scored: DataFrame, sets: dict, metric: str) -> list[float | None]:
    """One metric of every (label, prediction) set in one aggregate; None without rows."""
    row = regression_metrics_sets(scored, sets).first()
    return [None if row[f"{p}{metric}"] is None else float(row[f"{p}{metric}"]) for p in sets]


FIT_ROWS = 200_000


def fit_layout(n_rows: int, n_parts: int, cores: int, n_fits: int) -> tuple[int, int]:
    """(fits at once, partitions per fit) for fits on ``n_rows`` rows each.

    Tree fitting merges one dense histogram per node per partition per level,
    so a partition should hold many rows: one for each FIT_ROWS rows, however
    many cores there are. (Never more than the table has: narrowing it is a
    coalesce, without a shuffle.) Fits run side by side until the cores are
    busy. At 10^9 rows a fit has 5000 partitions.
    """
    per_fit = max(1, min(n_parts, math.ceil(n_rows / FIT_ROWS)))
    return max(1, min(n_fits, math.ceil(cores / per_fit))), per_fit


def fits_at_once(df: DataFrame, n_rows: int, n_fits: int, parallelism: int | None = None) -> tuple[int, int | None]:
    """(fits at once, partitions per fit; None: the table's own) for fits on ``n_rows`` rows of ``df``.

    Two at least where there are two: one's tasks run while the driver merges the other's.
    """
    if parallelism is not None:
        return max(1, min(parallelism, n_fits)), None
    par, per_fit = fit_layout(n_rows, df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism, n_fits)
    return max(1, min(n_fits, max(2, par))), per_fit


def _narrowed(df: DataFrame, partitions: int | None, of: int) -> DataFrame:
    return df.coalesce(partitions) if partitions is not None and partitions < of else df


def depth_predictions(model, depths: Sequence[int]) -> dict[int, list[float]]:
    """{depth: prediction by leaf index} of a tree cut at each depth.

    A tree grown to depth d is the upper part of one grown deeper with the
    same settings, so one deep fit holds the shallower ones. Read from the
    saved model's node table: at most 2^(depth + 1) rows.
    """
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    path = shared_dir(spark, "tree")
    model.write().save(path)
    try:
        nodes = {r.id: r for r in spark.read.parquet(f"{path}/data").select("id", "prediction", "leftChild", "rightChild").collect()}
    finally:
        fs.remove(spark, path)
    out = {d: [] for d in depths}

    def walk(i: int, above: list[float]) -> None:
        above = [*above, nodes[i].prediction]
        if nodes[i].leftChild < 0:
            for d in depths:
                out[d].append(above[min(d, len(above) - 1)])
        else:
            walk(nodes[i].leftChild, above)
            walk(nodes[i].rightChild, above)
    walk(0, [])
    return out


def _params_json(pm: dict) -> str:
    return json.dumps({p.name: v.item() if hasattr(v, "item") else v for p, v in pm.items()}, sort_keys=True, default=str)


class Progress:
    """Metrics of a search's finished fits, as small Parquet tables in one folder.

    A fit's rows (fold, params, value) are written beside their name and
    renamed, so a table that is there is whole. They count only for the same
    search: the folder below ``root`` is named by a digest of the table's rows
    (one aggregate over all columns, whatever their layout), the feature
    stages, the estimator's settings, label, folds and metric. Candidates may
    be added to the grid later.
    """

    _SCHEMA = "fold int, params string, value double"

    def __init__(self, df: DataFrame, root: str, feature_stages: Callable[[], list], estimator, label: str,
                 fold_col: str, num_folds: int, metric: str):
        self.spark = df.sparkSession
        rows = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*df.columns)),
                      F.sum(F.xxhash64(F.lit("sum"), *df.columns).cast("decimal(38,0)"))).first()
        stages = [*feature_stages(), estimator]
        # settings other than the grid's, with the stages' random ids taken out of derived column names
        settings = [(type(s).__name__, sorted((p.name, str(v).replace(s.uid, "")) for p, v in s.extractParamMap().items())) for s in stages]
        what = repr((sorted(df.dtypes), [str(x) for x in rows], settings, label, fold_col, num_folds, metric))
        self.path = f"{root.rstrip('/')}/{hashlib.md5(what.encode()).hexdigest()}"

    def read(self) -> dict[tuple[int, str], float | None]:
        """{(fold, params): value}: a row a fold and candidate at most."""
        tables = [f"{self.path}/{n}" for n in fs.children(self.spark, self.path) if n.startswith("fit-")]
        if not tables:
            return {}
        return {(r["fold"], r["params"]): r["value"] for r in self.spark.read.schema(self._SCHEMA).parquet(*tables).collect()}

    def write(self, fold: int, found: dict[str, float | None]) -> None:
        rows = [(fold, params, value) for params, value in found.items()]
        name = hashlib.md5(repr(sorted(r[:2] for r in rows)).encode()).hexdigest()[:16]
        built = f"{self.path}/writing-{uuid.uuid4().hex[:12]}"
        self.spark.createDataFrame(rows, self._SCHEMA).coalesce(1).write.parquet(built)
        fs.publish(self.spark, built, f"{self.path}/fit-{name}")


def _nested(estimator, maps: list[dict]) -> list[tuple[dict, list[int]]]:
    """(params to fit, candidates it serves): trees that differ in depth only share the deepest fit."""
    depth = estimator.maxDepth if isinstance(estimator, DecisionTreeRegressor) else None
    groups: dict[tuple, list[int]] = {}
    for i, pm in enumerate(maps):
        rest = tuple(sorted((p.name, v) for p, v in pm.items() if p != depth)) if depth in pm else ("", i)
        groups.setdefault(rest, []).append(i)
    return [(max((maps[i] for i in g), key=lambda pm: pm.get(depth, 0) if depth is not None else 0), g) for g in groups.values()]


@dataclass
class Search:
    """A grid to search for one estimator on one label; ``progress`` as for ``cross_validate``."""
    estimator: object
    grid: dict[str, Sequence]
    label: str
    progress: str | None = None


class _Running:
    """A search under way: its fits, what is known of them, and one fit's work."""

    def __init__(self, search: Search, df: DataFrame, feature_stages: Callable[[], list], fold_col: str, num_folds: int, metric: str):
        self.estimator, self.label, self.metric = search.estimator, search.label, metric
        self.grid_names = list(search.grid.keys())
        self.maps = param_grid(search.estimator, search.grid)
        self.fits = _nested(search.estimator, self.maps)
        self.values: list[list[float | None]] = [[None] * num_folds for _ in self.maps]
        self.names = [_params_json(pm) for pm in self.maps]
        self.done: set[tuple[int, int]] = set()  # (fold, first candidate served)
        self.log = None
        if search.progress:
            self.log = Progress(df, search.progress, feature_stages, search.estimator, search.label, fold_col, num_folds, metric)
            kept = self.log.read()
            for f in range(num_folds):
                for _, served in self.fits:
                    if all((f, self.names[i]) in kept for i in served):
                        self.done.add((f, served[0]))
                        for i in served:
                            self.values[i][f] = kept[f, self.names[i]]

    def todo(self, f: int) -> list[tuple[dict, list[int]]]:
        return [(pm, served) for pm, served in self.fits if (f, served[0]) not in self.done]

    def fit_eval(self, f: int, tr: DataFrame, va: DataFrame, pm: dict, served: list[int]) -> None:
        est, label = self.estimator, self.label
        depths = [self.maps[i].get(est.maxDepth) for i in served] if len(served) > 1 else []
        if not depths:
            model = est.fit(tr, pm)
            found = _metric_values(model.transform(va), {"": (label, "prediction")}, self.metric)
        else:
            model = est.copy({est.leafCol: "__leaf"}).fit(tr, pm)
            by_depth = depth_predictions(model, depths)
            scored = model.transform(va).withColumns({
                f"__p{d}": F.element_at(F.lit(by_depth[d]), F.col("__leaf").cast("int") + 1) for d in depths})
            found = _metric_values(scored, {f"d{d}_": (label, f"__p{d}") for d in depths}, self.metric)
        for i, value in zip(served, found):
            self.values[i][f] = value
        if self.log:
            self.log.write(f, {self.names[i]: value for i, value in zip(served, found)})

    def result(self) -> CVResult:
        if all(v is None for v in self.values[0]):
            raise ValueError("no fold has rows to score")
        return CVResult(self.grid_names, self.maps, self.values, self.metric)


def cross_validate(df: DataFrame, feature_stages: Callable[[], list], estimator,
                   grid: dict[str, Sequence], label: str, fold_col: str,
                   num_folds: int, metric: str = "rmse", parallelism: int | None = None,
                   persist: bool = True, n_rows: int | None = None, progress: str | None = None) -> CVResult:
    """k-fold CV; rows with ``fold_col == f`` validate fold f.

    feature_stages  factory returning fresh, unfitted feature stages
    parallelism     (fold, candidate) fits running at once, on the table's own
                    partitions; None picks it and the partitions of each fit
                    with ``fits_at_once``. Driver threads only submit jobs;
                    executors do the work.
    n_rows          the table's rows, if known
    progress        folder that keeps the metric of each finished fit (see
                    ``Progress``); a search that broke off goes on from there.
                    Whoever gives the folder removes it

    Decision trees that differ in depth only are read off the deepest one. A
    fold without rows to score counts in no mean; without training rows, or if
    all folds are such, an error names it.
    """
    return cross_validate_all(df, feature_stages, [Search(estimator, grid, label, progress)], fold_col, num_folds, metric,
                              parallelism=parallelism, persist=persist, n_rows=n_rows)[0]


def cross_validate_all(df: DataFrame, feature_stages: Callable[[], list], searches: Sequence[Search], fold_col: str,
                       num_folds: int, metric: str = "rmse", parallelism: int | None = None,
                       persist: bool = True, n_rows: int | None = None) -> list[CVResult]:
    """``cross_validate`` for several estimators and labels at once: a result for each search.

    Each fold's feature stages are fitted once on its training rows and the
    transformed rows, with the labels of all searches, are kept (memory and
    disk) for all fits of the fold, then freed, also after an error. Held are
    the folds whose fits run and, for small tables, one more, which is encoded
    meanwhile.
    """
    running = [_Running(s, df, feature_stages, fold_col, num_folds, metric) for s in searches]
    todo = {f: [(r, pm, served) for r in running for pm, served in r.todo(f)] for f in range(num_folds)}
    n_fits = max(1, sum(map(len, todo.values())))
    sizes = {r[0]: r[1] for r in df.groupBy(fold_col).count().collect()} if any(todo.values()) else {}
    n_rows = sum(sizes.values()) if n_rows is None else n_rows
    n_parts = df.rdd.getNumPartitions()
    par, per_fit = fits_at_once(df, n_rows * (num_folds - 1) // max(1, num_folds), n_fits, parallelism)
    most = max(1, *map(len, todo.values())) if todo else 1  # fits of a fold
    # an estimator that reads its rows more than twice, or several that read the same rows
    keep = persist and (most > 1 or any(isinstance(r.estimator, (DecisionTreeRegressor, RandomForestRegressor)) for r in running))

    def fold_data(f):
        train_f = df.where(F.col(fold_col) != F.lit(f))
        valid_f = df.where(F.col(fold_col) == F.lit(f))
        if not sum(n for fold, n in sizes.items() if fold is not None and fold != f):
            raise ValueError(f"fold {f} has no training rows")
        stages = feature_stages()
        feats = Pipeline(stages=stages).fit(train_f) if stages else PipelineModel(stages=[])
        # Fits and scoring read only the labels and the feature vector.
        needed = dict.fromkeys([*(r.label for r in running), *(r.estimator.getFeaturesCol() for r in running)])
        tr, va = (_narrowed(feats.transform(x).select(*needed), per_fit, n_parts) for x in (train_f, valid_f))
        return (tr.persist(StorageLevel.MEMORY_AND_DISK), va.persist(StorageLevel.MEMORY_AND_DISK)) if keep else (tr, va)

    # folds held at a time; a next one is encoded meanwhile unless one fold's stages fill the cores
    more = per_fit is None or per_fit < df.sparkSession.sparkContext.defaultParallelism
    room = Semaphore(min(num_folds, math.ceil(par / most) + more))

    def run_fold(f, pool):
        if not todo[f]:
            return
        with room:
            tr, va = fold_data(f)
            try:
                if keep:  # else fits that begin together would wait for each other's blocks
                    tr.count(), va.count()
                for job in [pool.submit(r.fit_eval, f, tr, va, pm, served) for r, pm, served in todo[f]]:
                    job.result()
            finally:
                if keep:
                    tr.unpersist()
                    va.unpersist()

    with ThreadPoolExecutor(max_workers=par) as pool, ThreadPoolExecutor(max_workers=num_folds) as folds:
        for fold in [folds.submit(run_fold, f, pool) for f in range(num_folds)]:
            fold.result()
    return [r.result() for r in running]


def cross_validate_plain(df: DataFrame, feature_stages: Callable[[], list], estimator,
                         grid: dict[str, Sequence], label: str, fold_col: str,
                         num_folds: int, metric: str = "rmse", parallelism: int = 1) -> CVResult:
    """The original's form: ``CrossValidator`` over the whole pipeline.

    Kept to measure against and to check ``cross_validate`` against.
    """
    maps = param_grid(estimator, grid)
    pipeline = Pipeline(stages=feature_stages() + [estimator])
    evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=maps, evaluator=evaluator,
                        numFolds=num_folds, foldCol=fold_col, parallelism=parallelism)
    cv_model = cv.fit(df)
    # Spark reports only averages here; each fold gets the average so the
    # means of the two forms compare directly.
    metrics = [[float(m)] for m in cv_model.avgMetrics]
    return CVResult(list(grid.keys()), maps, metrics, metric)


@contextmanager
def encoded(df: DataFrame, feature_stages: Callable[[], list], columns: Sequence[str],
            n_rows: int) -> Iterator[tuple[PipelineModel, DataFrame]]:
    """(feature stages fitted on all rows of ``df``, ``columns`` of the rows they give), for several ``fit_best``.

    The rows are kept (memory and disk) until the scope ends.
    """
    stages = feature_stages()
    feats = Pipeline(stages=stages).fit(df) if stages else PipelineModel(stages=[])
    n_parts = df.rdd.getNumPartitions()
    _, per_fit = fits_at_once(df, n_rows, 1)
    rows = _narrowed(feats.transform(df).select(*dict.fromkeys(columns)), per_fit, n_parts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows.count()
        yield feats, rows
    finally:
        rows.unpersist()


def fit_best(df: DataFrame, feature_stages: Callable[[], list], estimator,
             params: dict, given: tuple[PipelineModel, DataFrame] | None = None) -> PipelineModel:
    """Refit features + the chosen candidate on all training rows.

    Returns the whole PipelineModel (features and model together), so the
    held-out rows are transformed with the training rows' encoding. ``given``
    has the stages fitted on ``df`` and its encoded rows, if they are there
    already (``encoded``).
    """
    pm = {estimator.getParam(k): v for k, v in params.items()}
    model = estimator.copy(pm)
    if given is not None:
        feats, rows = given
        return PipelineModel(stages=[*feats.stages, model.fit(rows)])
    return Pipeline(stages=feature_stages() + [model]).fit(df)
