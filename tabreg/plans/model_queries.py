"""Registered queries for encoding, models, metrics and model selection.

Model oracles use shapes with a closed form (see the survey's recipes):
  * linear model with two features: the normal equations of the standardised
    columns, (R + lambda / sd_pop(y) I) b = r, solved for a 2 x 2 matrix
  * tree of few levels on features of many values: the best split of each
    node by running sums over the sorted values
  * tree deep enough to isolate every value of a low-cardinality feature,
    with enough bins: the group mean of the label
  * forest of such trees without bootstrap and with every feature: the same
Every fit uses the keyed 80/20 split of lineitem: fitted on the training
side, scored on all rows, so held-out rows are only ever transformed.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, estimators, features, indexing, metrics, sampling, selection, trees
from ..session import shared_dir
from ..sources import model_store, scratch
from ..spec import FeatureSpec
from .catalog import hash32_sql, register, round_doubles
from .fixtures import FLIGHTS_SQL, KEYS, flights, table
from . import workflow
from .prep_queries import _CAST, _DOUBLES, _hhmm_sql
from .tail_sql import t_tail_cte

_FX = f"fx as ({FLIGHTS_SQL})"
_K = ", ".join(KEYS)
_KQ = ", ".join(f"li.{k}" for k in KEYS)


# label / feature of the model oracles
Y = "y"
_LI_SQL = (f"li as (select {_K}, cast(l_quantity as double) as qx, cast(l_linenumber as double) as lx, "
           f"cast(dayofyear(l_shipdate) as double) as dx, l_extendedprice / 1000.0 as {Y}, l_returnflag, l_linestatus, "
           f"cast(year(l_shipdate) as varchar) as ship_year, cast(l_linenumber as varchar) as line_text, "
           f"case when l_suppkey % 10 = 0 then null when l_suppkey % 7 = 0 and {hash32_sql(KEYS)} % 100 >= 80 then 'held out only' "
           f"else 'S' || cast(l_suppkey % 40 as varchar) end as supp_group, "
           f"{hash32_sql(KEYS)} % 100 < 80 as is_train, "
           f"cast({hash32_sql(KEYS, 'fold')} % 3 as integer) as fold from lineitem)")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        *KEYS,
        F.col("l_quantity").cast("double").alias("qx"),
        F.col("l_linenumber").cast("double").alias("lx"),
        (F.col("l_extendedprice") / F.lit(1000.0)).alias(Y),
        "l_returnflag", "l_linestatus",
        F.year("l_shipdate").cast("string").alias("ship_year"),
        F.col("l_linenumber").cast("string").alias("line_text"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit(None).cast("string"))
         .when((F.col("l_suppkey") % 7 == 0) & (sampling.split_column(KEYS, 80) == F.lit("test")), F.lit("held out only"))
         .otherwise(F.concat(F.lit("S"), (F.col("l_suppkey") % 40).cast("string"))).alias("supp_group"),
        (sampling.split_column(KEYS, 80) == F.lit("train")).alias("is_train"),
        sampling.fold_column(KEYS, 3).alias("fold"),
    )


def _r(expr: str, digits: int = 6) -> str:
    # "+ 0.0" turns DuckDB's -0.0 (a tiny negative rounded away) into 0.0,
    # as Spark's decimal rounding gives.
    return f"(round({expr}, {digits}) + cast(0.0 as double))"


# ---------------------------------------------------------------- E1, S8
# Categories with a bounded number of values: the indexer keeps one label
# list per column on the driver, so a key-like column (cardinality growing
# with the table) would not hold at scale.
_INDEX_COLS = ("l_returnflag", "l_linestatus", "ship_year", "line_text", "supp_group")


def _label_cte(c: str) -> str:
    return (f"lab_{c} as (select {c} as v, cast(row_number() over (order by count(*) desc, {c}) - 1 as double) "
            f"as idx from li where is_train and {c} is not null group by {c})")


_STRING_INDEX_SQL = (
    f"with {_LI_SQL}, " + ", ".join(_label_cte(c) for c in _INDEX_COLS)
    + f" select {_KQ}, "
    + ", ".join(f"coalesce(lab_{c}.idx, (select cast(count(*) as double) from lab_{c})) as {c}Index"
                for c in _INDEX_COLS)
    + " from li " + " ".join(f"left join lab_{c} on li.{c} = lab_{c}.v" for c in _INDEX_COLS))


def _string_index_model(li: DataFrame):
    return features.string_indexer(_INDEX_COLS).fit(li.where("is_train"))


def _index_output(model, li: DataFrame) -> DataFrame:
    return model.transform(li).select(*KEYS, *[f"{c}Index" for c in _INDEX_COLS])


@register("string_index", _STRING_INDEX_SQL)
def q_string_index(spark, sf_dir):
    """Frequency-rank index fitted on the training rows, applied to all rows."""
    li = _lineitem(spark, sf_dir)
    return _index_output(_string_index_model(li), li)


@register("encoder_reuse", _STRING_INDEX_SQL)
def q_encoder_reuse(spark, sf_dir):
    """Fitted encoding saved, loaded back, and applied: same rows as string_index."""
    li = _lineitem(spark, sf_dir)
    fitted = Pipeline(stages=[features.string_indexer(_INDEX_COLS)]).fit(li.where("is_train"))
    path = model_store.save_model(fitted, shared_dir(spark, "encoder"))
    return _index_output(model_store.load_pipeline(path), li)


_KEY_INDEX_SQL = (
    f"with k as (select {_K}, case when l_partkey % 11 = 0 then null else 'P' || cast(l_partkey as varchar) end as part, "
    f"{hash32_sql(KEYS)} % 100 < 80 as is_train from lineitem), "
    "lab as (select part, cast(row_number() over (order by count(*) desc, part) - 1 as double) as idx "
    "from k where is_train and part is not null group by part) "
    f"select {', '.join('k.' + k for k in KEYS)}, coalesce(lab.idx, (select cast(count(*) as double) from lab)) as partIndex "
    "from k left join lab on k.part = lab.part")


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("l_partkey") % 11 != 0, F.concat(F.lit("P"), F.col("l_partkey").cast("string")))
    return table(spark, sf_dir, "lineitem").select(*KEYS, part.alias("part"),
                                                   (sampling.split_column(KEYS, 80) == F.lit("train")).alias("is_train"))


@register("string_index_keys", _KEY_INDEX_SQL)
def q_string_index_keys(spark, sf_dir):
    """Frequency-rank index of a column whose categories grow with the table, as a table and a join."""
    rows = _keyed(spark, sf_dir)
    return indexing.fit_string_index(rows.where("is_train"), "part").transform(rows).select(*KEYS, "partIndex")


# ------------------------------------------------------------ E2, E3, E4
_VEC = list(_DOUBLES)  # DepDelay, Distance, TaxiOut, ArrDelay as cast doubles


def _nan(c: str) -> str:
    return f"coalesce({c}, 'nan'::double)"


_NORM = " + ".join(f"abs({_nan(c)})" for c in _VEC)


@register("vector_assemble",
          f"with {_FX}, {_CAST} select {_K}, "
          + ", ".join(f"{_nan(c)} as v_{c}" for c in _VEC) + " from casted")
def q_vector_assemble(spark, sf_dir):
    """Cast flight numbers assembled into a vector (null -> NaN), spread back out."""
    df = clean.cast_double(clean.drop_columns(flights(spark, sf_dir), FeatureSpec().drop), _VEC)
    out = features.vector_assembler(_VEC).transform(df)
    return features.vector_columns(out, features.FEATURES, _VEC, prefix="v_", keep=KEYS)


@register("l1_normalize",
          f"with {_FX}, {_CAST}, n as (select *, {_NORM} as norm1 from casted) select {_K}, "
          + ", ".join(f"{_r(f'case when norm1 = 0 then {_nan(c)} else {_nan(c)} / norm1 end')} as n_{c}"
                      for c in _VEC) + " from n")
def q_l1_normalize(spark, sf_dir):
    """x / sum(|x|) per row; zero rows unchanged, NaN spreads over the row."""
    df = clean.cast_double(clean.drop_columns(flights(spark, sf_dir), FeatureSpec().drop), _VEC)
    out = Pipeline(stages=[features.vector_assembler(_VEC), features.l1_normalizer()]).fit(df).transform(df)
    return round_doubles(features.vector_columns(out, features.NORM_FEATURES, _VEC, prefix="n_", keep=KEYS))


_SPEC = FeatureSpec()


def _encoding_sql() -> str:
    """The 16 features: fills, category order and means from the training rows, applied to all rows."""
    mins = {f"{c}Min": _hhmm_sql(c) for c in _SPEC.clock}
    numbers = {**{c: f"case when isnan({c}) then null else {c} end" for c in _SPEC.continuous}, **mins}
    prep = (f"prep as (select {_K}, {', '.join(f'coalesce({c}, {chr(39)}No_{c}{chr(39)}) as {c}' for c in _SPEC.categorical)}, "
            f"{', '.join(f'{x} as {c}' for c, x in numbers.items())}, {hash32_sql(KEYS)} % 100 < 80 as is_train "
            f"from casted where ArrDelay is not null and not isnan(ArrDelay))")
    means = f"means as (select {', '.join(f'avg({c}) as m_{c}' for c in numbers)} from prep where is_train)"
    labs = ", ".join(
        f"lab_{c} as (select {c} as v, cast(row_number() over (order by count(*) desc, {c}) - 1 as double) as idx "
        f"from prep where is_train group by {c}), n_{c} as (select cast(count(*) as double) as n from lab_{c})" for c in _SPEC.categorical)
    values = ([f"coalesce(lab_{c}.idx, n_{c}.n) as {c}Index" for c in _SPEC.categorical] + [f"coalesce(prep.{c}, m_{c}) as {c}" for c in numbers])
    joins = "".join(f" left join lab_{c} on prep.{c} = lab_{c}.v" for c in _SPEC.categorical)
    singles = "".join(f" cross join n_{c}" for c in _SPEC.categorical)
    encoded = (f"enc as (select {', '.join('prep.' + k for k in KEYS)}, {', '.join(values)} from prep{joins} cross join means{singles})")
    norm = " + ".join(f"abs({n})" for n in _SPEC.feature_names)
    outs = ", ".join(f"{_r(f'case when norm = 0 then {n} else {n} / norm end')} as n_{n}" for n in _SPEC.feature_names)
    return f"with {_FX}, {_CAST}, {prep}, {means}, {labs}, {encoded} select {_K}, {outs} from (select *, {norm} as norm from enc)"


@register("feature_encoding", _encoding_sql())
def q_feature_encoding(spark, sf_dir):
    """Impute + index + assemble + L1-normalise, all 16 features: fitted on the training rows, applied to all."""
    prep = workflow.prepare(flights(spark, sf_dir), _SPEC).withColumn("is_train", sampling.split_column(KEYS, 80) == F.lit("train"))
    # written once: every stage's fit and the transform read it
    prep = scratch.cut(prep.select(*KEYS, *_SPEC.index_inputs, *_SPEC.numeric_inputs, "is_train"), "prepared")
    model = features.fit_features(prep.where("is_train"), _SPEC)
    out = model.transform(prep)
    return round_doubles(features.vector_columns(out, features.NORM_FEATURES, _SPEC.feature_names, prefix="n_", keep=KEYS))


# ------------------------------------------------------ M1, M4, M5, V1-V5
LR_LAMBDA = 0.1


LR_FEATURES = ["qx", "lx"]


def _lr_fit(spark, sf_dir, reg_param: float, solver: str = "auto"):
    li = _lineitem(spark, sf_dir)
    data = features.vector_assembler(LR_FEATURES).transform(li)
    lr = estimators.linear_regression(Y, features.FEATURES, regParam=reg_param, solver=solver)
    model = lr.fit(data.where("is_train"))
    return model, data


def _lr_sql(lam: float, body: str) -> str:
    return (f"with recursive {_LI_SQL}, fit as (select count(*) as n, avg({Y}) as my, stddev_pop({Y}) as sy, "
            f"avg(qx) as m1, stddev_pop(qx) as s1, avg(lx) as m2, stddev_pop(lx) as s2, corr({Y}, qx) as r1, "
            f"corr({Y}, lx) as r2, corr(qx, lx) as r12, 1 + {lam} / stddev_pop({Y}) as k from li where is_train), "
            f"slopes as (select (k * r1 - r12 * r2) / (k * k - r12 * r12) * sy / s1 as b1, "
            f"(k * r2 - r12 * r1) / (k * k - r12 * r12) * sy / s2 as b2, my, m1, m2 from fit), "
            f"coef as (select b1, b2, my - b1 * m1 - b2 * m2 as intercept from slopes), "
            f"scored as (select li.*, coef.intercept + b1 * qx + b2 * lx as prediction from li, coef) {body}")


@register("linear_regression",
          _lr_sql(LR_LAMBDA, f"select {_r('intercept')} as intercept, {_r('b1')} as coef_qx, {_r('b2')} as coef_lx from coef"))
def q_linear_regression(spark, sf_dir):
    """Ridge (regParam 0.1, standardised) of price/1000 on quantity and line number; fitted equation."""
    model, _ = _lr_fit(spark, sf_dir, LR_LAMBDA)
    coefs = estimators.coefficients(model, LR_FEATURES)
    return round_doubles(coefs.groupBy().agg(
        F.max(F.when(F.col("term") == "(intercept)", F.col("coefficient"))).alias("intercept"),
        *[F.max(F.when(F.col("term") == c, F.col("coefficient"))).alias(f"coef_{c}") for c in LR_FEATURES]))


@register("coefficients",
          _lr_sql(LR_LAMBDA, f"select 'qx' as term, {_r('b1')} as coefficient from coef "
                             f"union all select 'lx', {_r('b2')} from coef "
                             f"union all select '(intercept)', {_r('intercept')} from coef"))
def q_coefficients(spark, sf_dir):
    model, _ = _lr_fit(spark, sf_dir, LR_LAMBDA)
    return round_doubles(estimators.coefficients(model, LR_FEATURES))


@register("batch_score", _lr_sql(LR_LAMBDA, f"select {_K}, {_r('prediction', 4)} as prediction from scored"))
def q_batch_score(spark, sf_dir):
    """Every lineitem row scored by the model fitted on the training side."""
    model, data = _lr_fit(spark, sf_dir, LR_LAMBDA)
    return round_doubles(estimators.score(model, data).select(*KEYS, "prediction"), 4)


@register("residuals",
          _lr_sql(LR_LAMBDA, f"select {_K}, {Y} as label, {_r('prediction', 4)} as prediction, "
                             f"{_r(f'{Y} - prediction', 4)} as residual from scored"))
def q_residuals(spark, sf_dir):
    model, data = _lr_fit(spark, sf_dir, LR_LAMBDA)
    out = metrics.residuals(estimators.score(model, data), Y, keep=KEYS)
    return round_doubles(out, 4, only=["prediction", "residual"])


@register("regression_metrics",
          _lr_sql(LR_LAMBDA, "select count(*) as n, {mse} as mse, {rmse} as rmse, {r2} as r2, {mae} as mae "
                             "from scored where not is_train".format(
                                 mse=_r(f"avg(({Y} - prediction) * ({Y} - prediction))"),
                                 rmse=_r(f"sqrt(avg(({Y} - prediction) * ({Y} - prediction)))"),
                                 r2=_r(f"1 - avg(({Y} - prediction) * ({Y} - prediction)) / var_pop({Y})"),
                                 mae=_r(f"avg(abs({Y} - prediction))"))))
def q_regression_metrics(spark, sf_dir):
    """mse, rmse, r2, mae of the held-out rows in one aggregate."""
    model, data = _lr_fit(spark, sf_dir, LR_LAMBDA)
    test = estimators.score(model, data.where("not is_train"))
    return round_doubles(metrics.regression_metrics(test, Y))


def _summary_sql() -> str:
    e = f"({Y} - prediction)"
    inner = (f"select count(*) as n, avg({e} * {e}) as mse, avg(abs({e})) as mae, "
             f"1 - avg({e} * {e}) / var_pop({Y}) as r2, avg((prediction - my) * (prediction - my)) as ev, "
             f"min({e}) as mn, max({e}) as mx from scored, fit where is_train")
    outer = (f"select n as num_instances, {_r('r2')} as r2, {_r('1 - (1 - r2) * (n - 1) / (n - 3)')} as r2adj, "
             f"{_r('sqrt(mse)')} as rmse, {_r('mse')} as mse, {_r('mae')} as mae, "
             f"{_r('ev')} as explained_variance, n - 3 as degrees_of_freedom, "
             f"{_r('mn')} as min_residual, {_r('mx')} as max_residual, cast(0.0 as double) as reg_param, "
             f"cast(0.0 as double) as elastic_net_param, 100 as max_iter, '{Y}' as label_col, "
             f"0 as total_iterations, '0.0' as objective_history from ({inner})")
    return _lr_sql(0.0, outer)


@register("fit_summary", _summary_sql())
def q_fit_summary(spark, sf_dir):
    """Training summary of an unregularised fit (one aggregate over training rows) and its parameters.

    The normal-equation solver doesn't iterate: no iterations, one objective of 0.
    """
    model, data = _lr_fit(spark, sf_dir, 0.0, solver="normal")
    train = estimators.score(model, data.where("is_train"))
    out = round_doubles(metrics.fit_summary(model, train, Y))
    return out.withColumn("objective_history", F.concat_ws(",", F.col("objective_history").cast("array<string>")))


def _coef_stats_sql() -> str:
    e = f"({Y} - prediction)"
    det = "(1 - fit.r12 * fit.r12)"
    z1, z2 = "(fit.m1 / fit.s1)", "(fit.m2 / fit.s2)"
    body = (f", s as (select sum({e} * {e}) / (count(*) - 3) as v from scored where is_train), "
            f"terms as (select 'qx' as term, coef.b1 as c, sqrt(s.v / (fit.n * {det})) / fit.s1 as se from coef, s, fit "
            f"union all select 'lx', coef.b2, sqrt(s.v / (fit.n * {det})) / fit.s2 from coef, s, fit "
            f"union all select '(intercept)', coef.intercept, sqrt(s.v / fit.n * (1 + "
            f"({z1} * {z1} + {z2} * {z2} - 2 * fit.r12 * {z1} * {z2}) / {det})) from coef, s, fit), "
            f"tv as (select term as k, c / se as t, cast(fit.n - 3 as double) as dof from terms, fit), {t_tail_cte('tv')} "
            f"select term, {_r('c')} as coefficient, {_r('se')} as std_error, {_r('c / se', 4)} as t_value, "
            f"{_r('p')} as p_value from terms join t_tail on terms.term = t_tail.k")
    return _lr_sql(0.0, body)


@register("coefficient_stats", _coef_stats_sql())
def q_coefficient_stats(spark, sf_dir):
    """Standard error, t value and two-sided p value per term, intercept last."""
    model, _ = _lr_fit(spark, sf_dir, 0.0, solver="normal")
    stats = metrics.coefficient_stats(model, LR_FEATURES)
    return round_doubles(round_doubles(stats, 4, only=["t_value"]), 6,
                         only=["coefficient", "std_error", "p_value"])


# ----------------------------------------------------------- M2, M3, S6, S7
TREE_BINS = 64
TREE_DEPTH = 6

_GROUP_MEAN_SQL = (f"with {_LI_SQL}, g as (select lx, avg({Y}) as p from li where is_train group by lx) "
                   f"select {_KQ}, {_r('g.p')} as prediction from li join g on li.lx = g.lx")


def _tree_data(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    return features.vector_assembler(["lx"]).transform(li)


def _dt(spark):
    return estimators.decision_tree(Y, features.FEATURES, spark=spark, maxDepth=TREE_DEPTH, maxBins=TREE_BINS)


@register("decision_tree", _GROUP_MEAN_SQL)
def q_decision_tree(spark, sf_dir):
    """Depth-6 tree on line number: predictions are the training group means."""
    data = _tree_data(spark, sf_dir)
    model = _dt(spark).fit(data.where("is_train"))
    return round_doubles(estimators.score(model, data).select(*KEYS, "prediction"))


@register("random_forest", _GROUP_MEAN_SQL)
def q_random_forest(spark, sf_dir):
    """Forest of 3 trees without bootstrap, every feature: the same group means."""
    data = _tree_data(spark, sf_dir)
    rf = estimators.random_forest(Y, features.FEATURES, spark=spark, numTrees=3, maxDepth=TREE_DEPTH,
                                  maxBins=TREE_BINS, bootstrap=False, subsamplingRate=1.0,
                                  featureSubsetStrategy="all")
    model = rf.fit(data.where("is_train"))
    return round_doubles(estimators.score(model, data).select(*KEYS, "prediction"))


SPLIT_FEATURES = ["qx", "lx", "dx"]
SPLIT_DEPTH = 2


def _split_level(level: int) -> str:
    """CTEs of one level: every node's best split by running sums over the sorted values of each feature."""
    long = " union all ".join(f"select path, '{f}' as f, {f} as v, {Y} from at{level}" for f in SPLIT_FEATURES)
    whole = "rows between unbounded preceding and unbounded following"
    return (
        f"val{level} as (select path, f, v, count(*) as n, sum({Y}) as s, sum({Y} * {Y}) as q from ({long}) group by 1, 2, 3), "
        f"run{level} as (select path, f, v, lead(v) over o as next, sum(n) over o as ln, sum(s) over o as ls, sum(q) over o as lq, "
        f"sum(n) over w as n, sum(s) over w as s, sum(q) over w as q from val{level} "
        f"window o as (partition by path, f order by v), w as (partition by path, f order by v {whole})), "
        f"cand{level} as (select *, q / n - (s / n) * (s / n) - (lq - ls * ls / ln) / n "
        f"- ((q - lq) - (s - ls) * (s - ls) / (n - ln)) / n as gain from run{level} where next is not null), "
        f"best{level} as (select path, f, (v + next) / 2 as threshold, gain from cand{level} where gain > 0 "
        f"qualify row_number() over (partition by path order by gain desc, f, v) = 1), "
        f"at{level + 1} as (select a.* exclude (path), a.path || case when "
        f"case b.f {' '.join(f'when {chr(39)}{f}{chr(39)} then {f}' for f in SPLIT_FEATURES)} end <= b.threshold "
        f"then 'L' else 'R' end as path from at{level} a join best{level} b on a.path = b.path)")


def _splits_sql() -> str:
    levels = ", ".join(_split_level(i) for i in range(SPLIT_DEPTH))
    nodes = " union all ".join(f"select path, count(*) as n, avg({Y}) as p from at{i} group by path" for i in range(SPLIT_DEPTH + 1))
    best = " union all ".join(f"select * from best{i}" for i in range(SPLIT_DEPTH))
    dflt = estimators.DT_DEFAULTS["maxBins"]
    return (f"with {_LI_SQL}, at0 as (select '' as path, qx, lx, dx, {Y} from li where is_train), {levels} "
            f"select nodes.path, best.f as feature, best.threshold, nodes.n as n_rows, {_r('nodes.p')} as prediction, "
            f"{_r('best.gain')} as gain, {SPLIT_DEPTH} as max_depth, {dflt} as max_bins "
            f"from ({nodes}) nodes left join ({best}) best on nodes.path = best.path")


def _split_data(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_quantity").cast("double").alias("qx"), F.col("l_linenumber").cast("double").alias("lx"),
                     F.dayofyear("l_shipdate").cast("double").alias("dx"), (F.col("l_extendedprice") / F.lit(1000.0)).alias(Y),
                     (sampling.split_column(KEYS, 80) == F.lit("train")).alias("is_train"))
    return features.vector_assembler(SPLIT_FEATURES).transform(rows)


@register("tree_splits", _splits_sql())
def q_tree_splits(spark, sf_dir):
    """Nodes of a depth-2 tree with the default 7500 bins on three features of up to 366 values, as rows."""
    est = estimators.decision_tree(Y, features.FEATURES, spark=spark, maxDepth=SPLIT_DEPTH)
    model = est.fit(_split_data(spark, sf_dir).where("is_train"))
    chosen = estimators.chosen_params(model)
    nodes = trees.tree_nodes(spark, model_store.save_model(model, shared_dir(spark, "split-tree")), SPLIT_FEATURES)
    return round_doubles(nodes.select("path", "feature", "threshold", "n_rows", "prediction", "gain",
                                      F.lit(chosen["maxDepth"]).alias("max_depth"), F.lit(chosen["maxBins"]).alias("max_bins")),
                         only=["prediction", "gain"])


@register("forest_leaves")
def q_forest_leaves(spark, sf_dir):
    """Every leaf of the default forest (20 trees, depth 5, row and feature draws): what it predicts, and the training rows in it.

    n_draws counts the draws a tree was grown on; n_train and mean_train the
    training rows that reach the leaf, once each.
    """
    train = _split_data(spark, sf_dir).where("is_train")
    model = estimators.random_forest(Y, features.FEATURES, spark=spark).fit(train)
    nodes = trees.tree_nodes(spark, model_store.save_model(model, shared_dir(spark, "forest")), SPLIT_FEATURES)
    out = trees.leaf_means(model, train, nodes, Y).withColumn("num_trees", F.lit(estimators.chosen_params(model)["numTrees"]))
    return round_doubles(out, only=["prediction", "mean_train"])


@register("model_reuse", _GROUP_MEAN_SQL)
def q_model_reuse(spark, sf_dir):
    """load_or_train twice on one path: trains and saves, then loads and scores."""
    data = _tree_data(spark, sf_dir)
    path = shared_dir(spark, "dt-model")
    cls = estimators.MODEL_CLASSES["dt"]
    first, loaded = model_store.load_or_train(path, cls, lambda: _dt(spark).fit(data.where("is_train")))
    assert not loaded
    model, loaded = model_store.load_or_train(path, cls, _must_not_train)
    assert loaded
    return round_doubles(estimators.score(model, data).select(*KEYS, "prediction"))


def _must_not_train():
    raise AssertionError("load_or_train retrained a model that was saved")


# ----------------------------------------------------------------- T1-T3
CV_GRID = {"maxDepth": [0, TREE_DEPTH]}
CV_FOLDS = 3


def _cv(spark, sf_dir):
    data = _tree_data(spark, sf_dir)
    est = estimators.decision_tree(Y, features.FEATURES, spark=spark, maxBins=TREE_BINS)
    result = selection.cross_validate(data, lambda: [], est, CV_GRID, Y, "fold", CV_FOLDS,
                                      parallelism=2)
    return data, est, result


_CV_CTE = (
    f"{_LI_SQL}, folds as (select distinct fold from li), "
    f"d6 as (select t.fold, li.lx, avg(li.{Y}) as p from li, folds t where li.fold <> t.fold group by 1, 2), "
    f"d0 as (select t.fold, avg(li.{Y}) as p from li, folds t where li.fold <> t.fold group by 1), "
    f"r6 as (select li.fold, sqrt(avg((li.{Y} - d6.p) * (li.{Y} - d6.p))) as r from li join d6 "
    f"on li.fold = d6.fold and li.lx = d6.lx group by 1), "
    f"r0 as (select li.fold, sqrt(avg((li.{Y} - d0.p) * (li.{Y} - d0.p))) as r from li join d0 "
    f"on li.fold = d0.fold group by 1), "
    f"c as (select 0 as candidate, 0 as maxDepth, avg(r) as m from r0 "
    f"union all select 1, {TREE_DEPTH}, avg(r) from r6)")


@register("cross_validate",
          f"with {_CV_CTE} select cast(candidate as integer) as candidate, cast(maxDepth as integer) as maxDepth, "
          f"{_r('m')} as avg_rmse, m = min(m) over () as is_best from c")
def q_cross_validate(spark, sf_dir):
    """3-fold CV of tree depth {0, 6} on lineitem; mean rmse per candidate."""
    _, _, result = _cv(spark, sf_dir)
    return round_doubles(result.to_frame(spark))


@register("select_best",
          f"with {_CV_CTE}, best as (select maxDepth from c order by m limit 1), "
          f"p0 as (select avg({Y}) as p from li), p6 as (select lx, avg({Y}) as p from li group by lx) "
          f"select {_KQ}, (select cast(maxDepth as integer) from best) as best_maxDepth, "
          f"{_r(f'case when (select maxDepth from best) = 0 then p0.p else p6.p end')} as prediction "
          f"from li join p6 on li.lx = p6.lx, p0")
def q_select_best(spark, sf_dir):
    """Refit the best CV candidate on all rows and score them."""
    data, est, result = _cv(spark, sf_dir)
    model = selection.fit_best(data, lambda: [], est, result.best_params)
    best_depth = int(result.best_params["maxDepth"])
    out = estimators.score(model, data).select(*KEYS, F.lit(best_depth).alias("best_maxDepth"), "prediction")
    return round_doubles(out)
