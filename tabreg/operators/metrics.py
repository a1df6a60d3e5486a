"""Regression metrics, training summaries and coefficient statistics.

Each metric set is one aggregate (partial per partition, one final row)
over the scored rows, instead of one evaluator pass per metric.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import active_session

PREDICTION = "prediction"


def _metric_aggs(label: str, prediction: str, prefix: str = "") -> list[Column]:
    y, p = F.col(label), F.col(prediction)
    e = y - p
    return [
        F.count(F.lit(1)).alias(f"{prefix}n"),
        F.avg(e * e).alias(f"{prefix}mse"),
        F.avg(F.abs(e)).alias(f"{prefix}mae"),
        F.var_pop(y).alias(f"{prefix}var_label"),
        F.var_pop(p).alias(f"{prefix}var_pred"),
        (F.avg(p) - F.avg(y)).alias(f"{prefix}mean_gap"),
        F.min(e).alias(f"{prefix}min_residual"),
        F.max(e).alias(f"{prefix}max_residual"),
    ]


def _r2(mse: Column, var: Column) -> Column:
    """1 - mse / var as IEEE division gives it: a constant label has -inf, or NaN if it is predicted exactly."""
    return (F.when(var != 0, F.lit(1.0) - F.try_divide(mse, var))
            .when(mse > 0, F.lit(float("-inf"))).when(mse == 0, F.lit(float("nan"))))


def _metric_cols(prefix: str = "", extra: bool = False) -> list[Column]:
    def c(name):
        return F.col(f"{prefix}{name}")
    cols = [
        c("n").alias(f"{prefix}n"),
        c("mse").alias(f"{prefix}mse"),
        F.sqrt(c("mse")).alias(f"{prefix}rmse"),
        _r2(c("mse"), c("var_label")).alias(f"{prefix}r2"),
        c("mae").alias(f"{prefix}mae"),
    ]
    if extra:
        cols += [
            (c("var_pred") + c("mean_gap") * c("mean_gap")).alias(f"{prefix}explained_variance"),
            c("min_residual").alias(f"{prefix}min_residual"),
            c("max_residual").alias(f"{prefix}max_residual"),
        ]
    return cols


def regression_metrics(scored: DataFrame, label: str, prediction: str = PREDICTION,
                       extra: bool = False) -> DataFrame:
    """One row: n, mse, rmse, r2, mae (and more with ``extra``).

    r2 = 1 - SSE / SST with SST = n * var_pop(label), the definition of
    Spark's evaluator, also for a constant label (-inf; NaN if predicted
    exactly). No rows: n is 0 and the others are null. ``extra`` adds explained_variance (mean squared
    distance of predictions from the label mean) and the min / max residual.
    """
    return scored.agg(*_metric_aggs(label, prediction)).select(*_metric_cols(extra=extra))


def regression_metrics_sets(scored: DataFrame, sets: dict[str, tuple[str, str]]) -> DataFrame:
    """Several metric sets in one aggregate: ``{prefix: (label, prediction)}``.

    Output columns are ``<prefix>n``, ``<prefix>mse``, ... for every set.
    """
    aggs, cols = [], []
    for prefix, (label, prediction) in sets.items():
        aggs += _metric_aggs(label, prediction, prefix)
        cols += _metric_cols(prefix)
    return scored.agg(*aggs).select(*cols)


def residuals(scored: DataFrame, label: str, prediction: str = PREDICTION,
              keep: Sequence[str] = ()) -> DataFrame:
    """Per-row label, prediction and residual (label - prediction)."""
    return scored.select(*keep, F.col(label).alias("label"), F.col(prediction).alias("prediction"),
                         (F.col(label) - F.col(prediction)).alias("residual"))


def fit_summary(model: LinearRegressionModel, train_scored: DataFrame, label: str,
                num_features: int | None = None) -> DataFrame:
    """One-row training summary of a linear model.

    Error statistics come from one aggregate over the scored training rows;
    solver facts (iterations, objective history) from the fitted model when
    it still carries its summary (a loaded model does not).
    """
    p = num_features if num_features is not None else model.numFeatures
    fit_icpt = 1 if model.getFitIntercept() else 0
    m = regression_metrics(train_scored, label, extra=True)
    dof = F.col("n") - F.lit(p + fit_icpt)
    out = m.select(
        F.col("n").alias("num_instances"),
        F.col("r2"),
        (F.lit(1.0) - F.try_divide((F.lit(1.0) - F.col("r2")) * (F.col("n") - F.lit(fit_icpt)), dof)).alias("r2adj"),
        F.col("rmse"), F.col("mse"), F.col("mae"), F.col("explained_variance"),
        dof.alias("degrees_of_freedom"),
        F.col("min_residual"), F.col("max_residual"),
        F.lit(float(model.getRegParam())).alias("reg_param"),
        F.lit(float(model.getElasticNetParam())).alias("elastic_net_param"),
        F.lit(int(model.getMaxIter())).alias("max_iter"),
        F.lit(label).alias("label_col"),
    )
    if model.hasSummary:
        s = model.summary
        out = out.withColumns({
            "total_iterations": F.lit(int(s.totalIterations)),
            "objective_history": F.array(*[F.lit(float(v)) for v in s.objectiveHistory]).cast("array<double>"),
        })
    return out


def coefficient_stats(model: LinearRegressionModel, names: Sequence[str]) -> DataFrame:
    """(term, coefficient, std_error, t_value, p_value) per feature, then the intercept.

    Spark's summary arrays list the intercept last; the terms here follow
    that order, so every row's numbers belong to its own term. Needs the
    normal-equation solver and the model's training summary.
    """
    if not model.hasSummary:
        raise ValueError("coefficient statistics need the training summary of a freshly fitted model")
    s = model.summary
    try:
        se, tv, pv = s.coefficientStandardErrors, s.tValues, s.pValues
    except Exception as exc:  # noqa: BLE001 - Spark raises a plain error here
        raise ValueError("coefficient statistics need solver='normal' and elasticNetParam=0") from exc
    terms = list(names) + (["(intercept)"] if model.getFitIntercept() else [])
    coefs = [float(v) for v in model.coefficients.toArray()]
    if model.getFitIntercept():
        coefs.append(float(model.intercept))
    if len(terms) != len(se):
        raise ValueError(f"{len(se)} statistics for {len(terms)} terms")
    rows = [(t, c, float(e), float(tt), float(p)) for t, c, e, tt, p in zip(terms, coefs, se, tv, pv)]
    spark = active_session()
    return spark.createDataFrame(
        rows, "term string, coefficient double, std_error double, t_value double, p_value double")
