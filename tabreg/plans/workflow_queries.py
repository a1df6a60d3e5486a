"""Registered whole-workflow queries, on a feature whose models have a closed form.

One feature with few values (``TaxiOut``, whose gaps get the training mean),
not normalised: a tree of depth 6 or a forest without bootstrap predicts the
training mean of each value, a tree of depth 0 the overall one, and a linear
model the ridge line. So SQL gives each fold's rmse, the chosen depth and the
held-out metrics. The path is the library's own; ``entry()`` runs it with the
original's 16 features and grid. The comparison uses one clock feature instead:
its minutes and its day parts group the rows differently, so the modes differ.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.estimators import FOLDS
from ..spec import FeatureSpec
from .catalog import hash32_sql, register, round_doubles
from .fixtures import FLIGHTS_SQL, KEYS, flights
from .prep_queries import _day_part_sql, _hhmm_sql
from .workflow import compare_models, train_evaluate

SPEC = FeatureSpec(categorical=(), continuous=("TaxiOut",), clock=())
DEPTHS = [0, 6]
GRIDS = {"lr": {"regParam": [0.1]}, "dt": {"maxDepth": DEPTHS}, "rf": {}}
PARAMS = {"lr": {}, "dt": {"maxBins": 64},
          "rf": {"maxBins": 64, "maxDepth": 6, "numTrees": 3, "bootstrap": False, "featureSubsetStrategy": "all"}}


#: The comparison's clock column by line number: few times, day parts of different sizes; every second of the last line's is missing.
CLOCK_SPEC = FeatureSpec(categorical=(), continuous=(), clock=("DepTime",))
CLOCK_TIMES = {1: "630", 2: "1015", 3: "1100", 4: "1300", 5: "1640", 6: "2115", 7: "2330"}


def _run_ctes(tag: str, model: str, label: str, x: str = "x") -> tuple[str, str]:
    """CTEs of one run and the SELECT of its row; y is the label, x the feature or null."""
    y = "orig" if label == "ArrDelay" else "cbrt"
    k = FOLDS[model]
    t = f"r_{tag}"
    ctes = [f"{t} as materialized (select {x} as x, orig, {y} as y, is_train, cast({hash32_sql(KEYS, 'fold')} % {k} as integer) as fold from fx2)",
            f"{t}_f as (select unnest(range({k})) as f)"]

    def fitted(name: str, where: str, f: str, join: str) -> None:
        """Per fit: group means, overall mean, fill and ridge line."""
        if model == "lr":
            ctes.append(f"{name}_m as (select {f} as f, avg(x) as fill from {t} {join} where {where} group by all)")
            ctes.append(f"{name} as (select {f} as f, any_value(m.fill) as fill, avg(y) as my, avg(coalesce(x, m.fill)) as mx, "
                        f"regr_slope(y, coalesce(x, m.fill)) / (1 + 0.1 / stddev_pop(y)) as slope "
                        f"from {t} {join} join {name}_m m on m.f = {f} where {where} group by all)")
        else:
            ctes.append(f"{name} as (select {f} as f, x, avg(y) as p from {t} {join} where {where} group by all)")
            ctes.append(f"{name}_0 as (select {f} as f, avg(y) as p from {t} {join} where {where} group by all)")

    fitted(f"{t}_cv", f"is_train and fold <> {t}_f.f", f"{t}_f.f", f"cross join {t}_f")
    fitted(f"{t}_all", "is_train", "0", "")
    if model == "lr":
        line = "(c.my + c.slope * (coalesce({t}.x, c.fill) - c.mx))".format(t=t)
        ctes.append(f"{t}_e as (select fold, 0 as depth, sqrt(avg((y - {line}) * (y - {line}))) as e from {t} join {t}_cv c on c.f = fold "
                    f"where is_train group by fold)")
    else:
        ctes.append(f"{t}_e as (select fold, 6 as depth, sqrt(avg((y - c.p) * (y - c.p))) as e from {t} join {t}_cv c on c.f = fold and "
                    f"c.x is not distinct from {t}.x where is_train group by fold"
                    + (f" union all select fold, 0, sqrt(avg((y - c.p) * (y - c.p))) from {t} join {t}_cv_0 c on c.f = fold where is_train group by fold"
                       if model == "dt" else "") + ")")
    ctes.append(f"{t}_b as (select depth, avg(e) as cv from {t}_e group by depth order by cv limit 1)")
    if model == "lr":
        ctes.append(f"{t}_p as (select orig, y, {line} as p from {t} cross join {t}_all c where not is_train)")
    else:
        ctes.append(f"{t}_p as (select orig, y, case when (select depth from {t}_b) = 6 then c.p else o.p end as p from {t} "
                    f"join {t}_all c on c.x is not distinct from {t}.x cross join {t}_all_0 o where not is_train)")
    best = {"lr": "'{\"regParam\": 0.1}'", "dt": f"'{{\"maxDepth\": ' || (select depth from {t}_b) || '}}'", "rf": "'{}'"}[model]

    def four(prefix: str, a: str, p: str) -> str:
        e = f"({a} - {p})"
        return (f"round(avg({e} * {e}), 6) as {prefix}mse, round(sqrt(avg({e} * {e})), 6) as {prefix}rmse, "
                f"round(1 - avg({e} * {e}) / var_pop({a}), 6) as {prefix}r2, round(avg(abs({e})), 6) as {prefix}mae")
    orig = four("orig_", "orig", "p" if label == "ArrDelay" else "pow(p, 3)")
    return ", ".join(ctes), (f"select '{model}' as model, '{label}' as label, {best} as best_params, "
                             f"round((select cv from {t}_b), 6) as cv_rmse, count(*) as n_test, {four('', 'y', 'p')}, {orig} from {t}_p")


def _base(features: str, clock: str = "DepTime") -> str:
    return (f"fx as ({FLIGHTS_SQL}), fx0 as (select * replace ({clock} as DepTime) from fx), "
            f"fx1 as (select {', '.join(KEYS)}, try_cast(ArrDelay as double) as orig, {features} from fx0), "
            f"fx2 as materialized (select *, sign(orig) * pow(abs(orig), 1.0 / 3) as cbrt, "
            f"{hash32_sql(KEYS)} % 100 < 80 as is_train from fx1 where orig is not null)")


def _one_sql() -> str:
    ctes, select = _run_ctes("one", "dt", "ArrDelay")
    return f"with {_base('try_cast(TaxiOut as double) as x')}, {ctes} select 'numeric' as time_mode, * from ({select})"


def _comparison_sql() -> str:
    """One row for each (time mode, label, model); a line takes the day part's rank among the training rows."""
    times = ("case when l_linenumber = 7 and l_partkey % 2 = 0 then 'NA' "
             + " ".join(f"when l_linenumber = {k} then '{v}'" for k, v in CLOCK_TIMES.items()) + " end")
    base = _base(f"{_hhmm_sql('DepTime')} as minutes, coalesce({_day_part_sql('DepTime')}, 'No_DepTimeDisc') as part", times)
    ranks = "ranks as (select part as v, row_number() over (order by count(*) desc, part) - 1 as r from fx2 where is_train group by part)"
    ctes, selects = [base, ranks], []
    for mode, label, model in _ALL:
        x = "minutes" if mode == "numeric" else "part" if model != "lr" else "cast((select r from ranks where v = part) as double)"
        run, select = _run_ctes(f"{mode}_{model}_{len(selects)}", model, label, x)
        ctes.append(run)
        selects.append(f"select '{mode}' as time_mode, * from ({select})")
    return f"with {', '.join(ctes)} " + " union all ".join(selects)


_ALL = [(mode, label, model) for mode in ("numeric", "categorical") for label in ("ArrDelay", "ArrDelayCubeRoot") for model in ("lr", "dt", "rf")]


@register("train_evaluate", _one_sql())
def q_train_evaluate(spark, sf_dir):
    """Split, clean, 5-fold search of a tree's depth, refit, score all held-out rows."""
    ev = train_evaluate(flights(spark, sf_dir), SPEC, model="dt", keys=KEYS, max_rows=None, normalize=False,
                        grid=GRIDS["dt"], estimator_params=PARAMS["dt"])
    # One metrics row, computed while the training table is cached.
    row, schema = ev.metrics.first(), ev.metrics.schema
    ev.release()
    return round_doubles(spark.createDataFrame([row], schema).drop("model_params", "loaded"))


@register("model_comparison", _comparison_sql())
def q_model_comparison(spark, sf_dir):
    """lr / dt / rf x numeric / categorical time x ArrDelay / cube root, each with its folds."""
    time = F.lit("NA")
    for line, text in CLOCK_TIMES.items():
        time = F.when((F.col("l_linenumber") == line) & ((F.col("l_partkey") % 2 != 0) | (line < 7)), text).otherwise(time)
    raw = flights(spark, sf_dir).withColumn("DepTime", time)
    out = compare_models(raw, keys=KEYS, base=CLOCK_SPEC, max_rows=None, normalize=False, grid=GRIDS, estimator_params=PARAMS)
    return round_doubles(out.drop("model_params", "loaded"))
