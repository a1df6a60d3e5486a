"""Registered queries for sources, cleaning, time features and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefeat import cube_root, day_part, hhmm_to_minutes
from ..operators import clean, sampling
from ..session import shared_dir
from ..sources import io
from ..spec import CATEGORICAL, CLOCK, CONTINUOUS, DROPPED, LABEL, FeatureSpec
from .catalog import hash32_sql, register, round_doubles
from .fixtures import FLIGHTS_SQL, KEYS, RAW_COLUMNS, flights, table

# ---------------------------------------------------------------- SQL pieces
_FX = f"fx as ({FLIGHTS_SQL})"
_DOUBLES = list(CONTINUOUS) + [LABEL]
_CAST = (
    "casted as (select * exclude ({drop}) replace ({casts}) from fx)".format(
        drop=", ".join(DROPPED),
        casts=", ".join(f"try_cast({c} as double) as {c}" for c in _DOUBLES)))
_KEYS_SQL = ", ".join(KEYS)
_LINEITEM_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
                  "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus")


def _hhmm_sql(c: str) -> str:
    """Text rule of the original (last two digits minutes, rest hours)."""
    t = f"try_cast({c} as double)"
    s = f"cast(cast(trunc(case when isnan({t}) then 0 else {t} end) as integer) as varchar)"
    return (f"cast((case when length({s}) > 2 then try_cast(substr({s}, 1, length({s}) - 2) as integer) "
            f"else 0 end) * 60 + try_cast(right({s}, 2) as integer) as double)")


def _day_part_sql(c: str) -> str:
    t = f"try_cast({c} as double)"
    return (f"case when {t} is null then null when {t} >= 1 and {t} <= 1125 then 'Morning' "
            f"when {t} > 1125 and {t} <= 1750 then 'Afternoon' else 'Evening' end")


def _r(expr: str, digits: int = 6) -> str:
    # "+ 0.0" turns DuckDB's -0.0 (a tiny negative rounded away) into 0.0,
    # as Spark's decimal rounding gives.
    return f"(round({expr}, {digits}) + cast(0.0 as double))"


def _means_cte() -> str:
    means = ", ".join(f"avg(case when isnan({c}) then null else {c} end) as m_{c}" for c in _DOUBLES)
    return f"means as (select {means} from casted)"


def _filled_select(extra: str = "") -> str:
    """Label filter + mean fill + constant fill, the cleaning core as SQL."""
    fills = [f"{_r(f'coalesce(case when isnan({c}) then null else {c} end, m_{c})')} as {c}"
             for c in _DOUBLES]
    fills += [f"coalesce({c}, 'No_{c}') as {c}" for c in CATEGORICAL]
    return (f"select * exclude ({', '.join(_DOUBLES + list(CATEGORICAL))}, "
            f"{', '.join('m_' + c for c in _DOUBLES)}), {', '.join(fills)}{extra} "
            f"from casted, means where {LABEL} is not null and not isnan({LABEL})")


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights(spark, sf_dir)


def _casted(spark, sf_dir):
    df = clean.drop_columns(fx(spark, sf_dir), DROPPED)
    return clean.cast_double(df, _DOUBLES)


# ------------------------------------------------------------ S1-S5, S9, P6
@register("csv_scan", f"with {_FX} select * exclude ({_KEYS_SQL}) from fx")
def q_csv_scan(spark, sf_dir):
    """Raw CSV source: write the flight table as CSV, scan it back as strings."""
    path = shared_dir(spark, "csv_scan")
    io.write_csv(flights(spark, sf_dir, keep_keys=False), path)
    return io.read_raw(spark, path, columns=RAW_COLUMNS)


@register("parquet_roundtrip", f"with {_FX} select * from fx")
def q_parquet_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "parquet_roundtrip")
    io.write_table(fx(spark, sf_dir), path)
    return io.read_table(spark, path)


@register("read_or_build", f"with {_FX} select * from fx")
def q_read_or_build(spark, sf_dir):
    """Build-and-write on the first call, plain read on the second."""
    path = shared_dir(spark, "read_or_build")
    io.read_or_build(spark, path, lambda: fx(spark, sf_dir))
    return io.read_or_build(spark, path, _must_not_rebuild)


@register("input_manifest", f"with {_FX} select * from fx")
def q_input_manifest(spark, sf_dir):
    """A table built from a folder, read again while the folder stays, built anew when it gets another file."""
    source, path = shared_dir(spark, "manifest-input"), shared_dir(spark, "manifest-table")
    rows = fx(spark, sf_dir)
    io.write_table(rows.where("l_linenumber <= 3"), source)

    def build():
        return io.read_table(spark, source)
    io.read_or_build(spark, path, build, [source])
    io.read_or_build(spark, path, _must_not_rebuild, [source])
    io.write_table(rows.where("l_linenumber > 3"), source, mode="append")
    io.read_or_build(spark, path, build, [source])
    return io.read_or_build(spark, path, _must_not_rebuild, [source])


def _must_not_rebuild():
    raise AssertionError("read_or_build rebuilt a table that was already written")


@register("preview",
          f"with {_FX} select * from fx where cast({hash32_sql(KEYS, '1234')} as double) / 4294967296.0 < 0.1 "
          f"order by {_KEYS_SQL} limit 100")
def q_preview(spark, sf_dir):
    """Keyed 10 % sample (seed 1234), first 100 rows in key order."""
    return io.preview(fx(spark, sf_dir), n=100, fraction=0.1, seed=1234, keys=KEYS)


def _prep_schema_rows():
    spec = FeatureSpec()
    names = [c for c in RAW_COLUMNS if c not in DROPPED] + list(KEYS)
    types = {c: "string" for c in names}
    types.update({c: "double" for c in _DOUBLES})
    types.update({"l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint"})
    rows = [(c, types[c]) for c in names]
    rows += [(c, "double") for c in spec.derived_clock] + [("ArrDelayCubeRoot", "double")]
    return rows


def _schema_sql() -> str:
    rows = _prep_schema_rows()
    values = ", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(rows))
    return (f"select cast(p as integer) as position, c as column_name, t as data_type "
            f"from (values {values}) v(p, c, t)")


@register("schema_report", _schema_sql())
def q_schema_report(spark, sf_dir):
    """Column names and types of the cleaned flight table."""
    # types do not depend on the fill, and without it no pass over the table is made
    return io.schema_report(clean.preprocess(fx(spark, sf_dir), impute_means_from="none"))


# ----------------------------------------------------------------- A1, A2
@register("row_count", f"with {_FX} select count(*) as row_count from fx")
def q_row_count(spark, sf_dir):
    return clean.row_count(fx(spark, sf_dir))


@register("column_means",
          f"with {_FX}, {_CAST} select "
          + ", ".join(f"{_r(f'avg(case when isnan({c}) then null else {c} end)')} as {c}" for c in _DOUBLES)
          + " from casted")
def q_column_means(spark, sf_dir):
    """Mean of each cast double column over all rows (before the label filter)."""
    return round_doubles(clean.column_means(_casted(spark, sf_dir), _DOUBLES))


# ------------------------------------------------------------ P1, P2, F1
@register("drop_columns", f"with {_FX} select * exclude ({', '.join(DROPPED)}) from fx")
def q_drop_columns(spark, sf_dir):
    return clean.drop_columns(fx(spark, sf_dir), DROPPED)


@register("cast_double", f"with {_FX}, {_CAST} select * from casted")
def q_cast_double(spark, sf_dir):
    return _casted(spark, sf_dir)


@register("drop_null_label",
          f"with {_FX}, {_CAST} select * from casted where {LABEL} is not null and not isnan({LABEL})")
def q_drop_null_label(spark, sf_dir):
    return clean.drop_null_label(_casted(spark, sf_dir), LABEL)


# ------------------------------------------------------------ A2, A3, A4
@register("mean_impute",
          f"with {_FX}, {_CAST}, {_means_cte()} select * exclude ({', '.join('m_' + c for c in _DOUBLES)}) "
          f"replace ({', '.join(_r(f'coalesce(case when isnan({c}) then null else {c} end, m_{c})') + ' as ' + c for c in _DOUBLES)}) "
          f"from casted, means where {LABEL} is not null and not isnan({LABEL})")
def q_mean_impute(spark, sf_dir):
    """Label filter, then null/NaN doubles filled with means over all rows."""
    casted = _casted(spark, sf_dir)
    means = clean.collect_means(casted, _DOUBLES)
    out = clean.mean_impute(clean.drop_null_label(casted, LABEL), _DOUBLES, means=means)
    return round_doubles(out, only=_DOUBLES)


@register("constant_impute",
          f"with {_FX}, {_CAST} select * replace ("
          + ", ".join(f"coalesce({c}, 'No_{c}') as {c}" for c in CATEGORICAL) + ") from casted")
def q_constant_impute(spark, sf_dir):
    return clean.constant_impute(_casted(spark, sf_dir), CATEGORICAL)


# ------------------------------------------------------------ P3, P4, P5
@register("hhmm_to_minutes",
          f"with {_FX} select {_KEYS_SQL}, " + ", ".join(f"{_hhmm_sql(c)} as {c}Min" for c in CLOCK) + " from fx")
def q_hhmm_to_minutes(spark, sf_dir):
    return fx(spark, sf_dir).select(*KEYS, *[hhmm_to_minutes(c).alias(f"{c}Min") for c in CLOCK])


@register("day_part",
          f"with {_FX} select {_KEYS_SQL}, " + ", ".join(f"{_day_part_sql(c)} as {c}Disc" for c in CLOCK) + " from fx")
def q_day_part(spark, sf_dir):
    return fx(spark, sf_dir).select(*KEYS, *[day_part(c).alias(f"{c}Disc") for c in CLOCK])


@register("label_cube_root",
          f"with {_FX} select {_KEYS_SQL}, {_r('cbrt(try_cast(ArrDelay as double))')} as ArrDelayCubeRoot from fx")
def q_label_cube_root(spark, sf_dir):
    df = fx(spark, sf_dir).select(*KEYS, cube_root(F.col(LABEL).try_cast("double")).alias("ArrDelayCubeRoot"))
    return round_doubles(df)


# ------------------------------------------------------------------ P7, P8
@register("preprocess",
          f"with {_FX}, {_CAST}, {_means_cte()} "
          + _filled_select(", " + ", ".join(f"{_hhmm_sql(c)} as {c}Min" for c in CLOCK)
                           + f", {_r('cbrt(ArrDelay)')} as ArrDelayCubeRoot"))
def q_preprocess(spark, sf_dir):
    """The full cleaning chain, numeric time mode (the original's setting)."""
    return round_doubles(clean.preprocess(fx(spark, sf_dir), FeatureSpec(time_mode="numeric")))


@register("preprocess_categorical",
          f"with {_FX}, {_CAST}, {_means_cte()} "
          + _filled_select(", " + ", ".join(f"{_day_part_sql(c)} as {c}Disc" for c in CLOCK)
                           + f", {_r('cbrt(ArrDelay)')} as ArrDelayCubeRoot"))
def q_preprocess_categorical(spark, sf_dir):
    """The full cleaning chain with clock columns as day parts."""
    return round_doubles(clean.preprocess(fx(spark, sf_dir), FeatureSpec(time_mode="categorical")))


# ------------------------------------------------------------------ F2-F4
BOUNDED_SAMPLE_ROWS = 20_000


@register("bounded_sample",
          f"select {_LINEITEM_COLS} from lineitem, (select count(*) as n from lineitem) c "
          f"where cast({hash32_sql(KEYS, '1234')} as double) / 4294967296.0 "
          f"< least(1.0, cast({BOUNDED_SAMPLE_ROWS} as double) / cast(c.n as double))")
def q_bounded_sample(spark, sf_dir):
    """Keyed sample of about 20 000 lineitem rows (seed 1234)."""
    li = table(spark, sf_dir, "lineitem")
    return sampling.bounded_sample(li, max_rows=BOUNDED_SAMPLE_ROWS, keys=KEYS, seed=1234) \
        .select(*[c.strip() for c in _LINEITEM_COLS.split(",")])


@register("train_test_split",
          f"select {_KEYS_SQL}, case when {hash32_sql(KEYS)} % 100 < 80 then 'train' else 'test' end as split "
          f"from lineitem")
def q_train_test_split(spark, sf_dir):
    """Keyed 80/20 split of lineitem; every row labelled with its side."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(*KEYS, sampling.split_column(KEYS, 80).alias("split"))
