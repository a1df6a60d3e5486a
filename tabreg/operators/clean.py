"""Cleaning: drop, cast, label filter, imputation and the whole chain.

Every step is a projection or filter Catalyst folds into one stage. The only
job that runs while a plan is being built is ``column_means``: one partial
aggregate per partition and a single-row final, no matter how many
columns are averaged (the original ran one job per column).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefeat import as_double, cube_root, day_part, minutes_from_parts, truncate_to_int
from ..spec import LABEL, LABEL_CUBE_ROOT, MISSING_CATEGORY_PREFIX, FeatureSpec


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns; names that are not there are ignored."""
    return df.drop(*names)


def cast_double(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Cast the named columns to double in place; unparseable text -> null. A missing column raises."""
    require_columns(df, names)
    return df.withColumns({c: F.col(c).try_cast("double") for c in names})


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"column(s) not in the table: {missing}")


def drop_null_label(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Drop rows whose label is null or NaN."""
    return df.na.drop(subset=[label])


def row_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row DataFrame (partial counts, one final row)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def _non_nan(c: str):
    col = F.col(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def column_means(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row holding the mean of every named column (nulls and NaN ignored).

    Output column names equal the input names.
    """
    return df.agg(*[F.avg(_non_nan(c)).alias(c) for c in names])


def collect_means(df: DataFrame, names: Sequence[str]) -> dict[str, float]:
    """The means of ``column_means`` as a dict (one small row to the driver)."""
    if not names:
        return {}
    row = column_means(df, names).first()
    means = row.asDict()
    empty = [c for c, v in means.items() if v is None]
    if empty:
        raise ValueError(f"cannot mean-impute column(s) with no non-null value: {empty}")
    return means


def mean_impute(df: DataFrame, names: Sequence[str],
                means: Mapping[str, float] | None = None,
                stats_from: DataFrame | None = None) -> DataFrame:
    """Replace null and NaN in double columns by a mean.

    The means come from ``means`` if given, else from ``stats_from`` (default
    ``df`` itself). Passing the training rows as ``stats_from`` keeps test
    rows out of the fill value.
    """
    if means is None:
        means = collect_means(stats_from if stats_from is not None else df, names)
    return df.na.fill({c: float(means[c]) for c in names})


def constant_impute(df: DataFrame, names: Sequence[str],
                    prefix: str = MISSING_CATEGORY_PREFIX,
                    na_tokens: Sequence[str] = ()) -> DataFrame:
    """Replace null in string columns by ``<prefix><column>``.

    The literal text "NA" is an ordinary category unless listed in
    ``na_tokens``, in which case it is treated as missing too.
    """
    if na_tokens:
        tokens = list(na_tokens)
        df = df.withColumns({c: F.when(F.col(c).isin(tokens), F.lit(None)).otherwise(F.col(c))
                             for c in names})
    return df.na.fill({c: f"{prefix}{c}" for c in names})


def split_by_type(df: DataFrame, names: Sequence[str]) -> tuple[list[str], list[str]]:
    """Split column names into (double, string) by the frame's schema. A missing column raises."""
    require_columns(df, names)
    types = {f.name: f.dataType for f in df.schema.fields}
    doubles, strings = [], []
    for c in names:
        t = types.get(c, T.StringType())
        if isinstance(t, T.DoubleType):
            doubles.append(c)
        elif isinstance(t, T.StringType):
            strings.append(c)
        else:
            raise TypeError(f"column {c!r} has type {t.simpleString()}; only double or string can be imputed")
    return doubles, strings


def handle_missing(df: DataFrame, names: Sequence[str], label: str = LABEL,
                   na_tokens: Sequence[str] = ()) -> DataFrame:
    """Label filter, then mean fill of doubles and constant fill of strings.

    As in the original, means are taken over all rows of ``df`` (before the
    label filter).
    """
    doubles, strings = split_by_type(df, names)
    means = collect_means(df, doubles)
    out = drop_null_label(df, label)
    if doubles:
        out = mean_impute(out, doubles, means=means)
    if strings:
        out = constant_impute(out, strings, na_tokens=na_tokens)
    return out


def add_clock_features(df: DataFrame, clock: Sequence[str], time_mode: str = "numeric") -> DataFrame:
    """Append ``<c>Min`` (minutes, double) or ``<c>Disc`` (day part, string).

    The clock text is parsed to double once, and (numeric mode) truncated to
    an integer once, each in its own projection; the final CASE reads those
    columns. Catalyst keeps a non-trivial expression with several consumers
    in its own projection, so nothing is re-parsed per branch and the
    generated code stays small enough for whole-stage codegen (inlining the
    four expanded CASEs made the stage several times slower).
    """
    parsed = {f"__t_{c}": as_double(c) for c in clock}
    out = df.withColumns(parsed)
    if time_mode == "numeric":
        trunc = {f"__i_{c}": truncate_to_int(F.col(f"__t_{c}")).cast("bigint") for c in clock}
        out = out.withColumns(trunc)
        out = out.withColumns({f"{c}Min": minutes_from_parts(F.col(f"__t_{c}"), F.col(f"__i_{c}"))
                               for c in clock})
        out = out.drop(*trunc)
    else:
        out = out.withColumns({f"{c}Disc": day_part(F.col(f"__t_{c}")) for c in clock})
    return out.drop(*parsed)


def add_label_cube_root(df: DataFrame, label: str = LABEL, out: str = LABEL_CUBE_ROOT) -> DataFrame:
    return df.withColumn(out, cube_root(label))


def preprocess(df: DataFrame, spec: FeatureSpec = FeatureSpec(),
               impute_means_from: str = "all") -> DataFrame:
    """The whole cleaning chain of the original, on any raw flight table.

    drop -> cast continuous + label to double -> label filter -> mean fill of
    doubles (means over all rows) and ``No_<c>`` fill of strings -> clock
    features -> cube-root label. Clock columns and the derived clock
    features are not imputed here, exactly as in the original; the model
    workflow fills them inside its fitted pipeline.

    ``impute_means_from="none"`` skips the mean fill of doubles so that a
    fitted ``Imputer`` can do it from training rows only.
    """
    raw_label = spec.raw_label
    out = drop_columns(df, spec.drop)
    out = cast_double(out, list(spec.continuous) + [raw_label])
    to_fill = list(spec.categorical) + list(spec.continuous) + [raw_label]
    if impute_means_from == "all":
        out = handle_missing(out, to_fill, label=raw_label, na_tokens=spec.na_tokens)
    elif impute_means_from == "none":
        _, strings = split_by_type(out, to_fill)
        out = constant_impute(drop_null_label(out, raw_label), strings, na_tokens=spec.na_tokens)
    else:
        raise ValueError("impute_means_from must be 'all' or 'none'")
    out = add_clock_features(out, spec.clock, spec.time_mode)
    return add_label_cube_root(out, raw_label)
