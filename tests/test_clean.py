"""Cleaning operators: drop, cast, label filter, imputation, the whole chain."""

import pytest
from pyspark.sql import functions as F

from tabreg.operators import clean
from tabreg.spec import CATEGORICAL, CLOCK, CONTINUOUS, DROPPED, FeatureSpec

DOUBLES = list(CONTINUOUS) + ["ArrDelay"]


def test_fixture_aggregates_sf0001(fx):
    # values stated in FIXTURES.md for sf0.001
    casted = clean.cast_double(clean.drop_columns(fx, DROPPED), DOUBLES)
    row = casted.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("ArrDelay").isNull(), 1)).alias("null_label"),
        F.avg("DepDelay").alias("mean_dep"),
        F.count(F.when(F.col("TailNum").isNull(), 1)).alias("tail_null"),
        F.count(F.when(F.col("TailNum") == "NA", 1)).alias("tail_na"),
        F.count(F.when(F.col("DepDelay").isNull(), 1)).alias("dep_null"),
        F.count(F.when(F.col("TaxiOut").isNull(), 1)).alias("taxi_null"),
        F.sum("Distance").alias("dist"),
    ).first()
    assert (row.n, row.null_label, row.tail_null, row.tail_na, row.dep_null, row.taxi_null) == \
        (6000, 142, 545, 640, 918, 617)
    assert row.mean_dep == pytest.approx(0.415191, abs=1e-6)
    assert row.dist == 6347296


def test_drop_ignores_missing(fx):
    out = clean.drop_columns(fx, ["ArrTime", "NoSuchColumn"])
    assert "ArrTime" not in out.columns and len(out.columns) == len(fx.columns) - 1


def test_cast_text_na_to_null(spark):
    df = spark.createDataFrame([("1.5",), ("NA",), (None,), ("x",)], "DepDelay string")
    got = [r[0] for r in clean.cast_double(df, ["DepDelay"]).collect()]
    assert got == [1.5, None, None, None]


def test_drop_null_label_drops_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "ArrDelay double")
    assert clean.drop_null_label(df).count() == 1


def test_mean_impute_fills_null_and_nan_from_stats(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    out = clean.mean_impute(df, ["x"])
    assert sorted(r[0] for r in out.collect()) == [1.0, 2.0, 2.0, 3.0]
    stats = spark.createDataFrame([(10.0,)], "x double")
    out = clean.mean_impute(df, ["x"], stats_from=stats)
    assert sorted(r[0] for r in out.collect()) == [1.0, 3.0, 10.0, 10.0]


def test_mean_impute_all_null_column_raises(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    with pytest.raises(ValueError, match="x"):
        clean.mean_impute(df, ["x"])


def test_constant_impute_keeps_na_text(spark):
    df = spark.createDataFrame([("NA",), (None,), ("N1",)], "TailNum string")
    assert [r[0] for r in clean.constant_impute(df, ["TailNum"]).collect()] == ["NA", "No_TailNum", "N1"]
    out = clean.constant_impute(df, ["TailNum"], na_tokens=["NA"])
    assert [r[0] for r in out.collect()] == ["No_TailNum", "No_TailNum", "N1"]


def test_preprocess_layout_and_means_over_all_rows(fx):
    out = clean.preprocess(fx, FeatureSpec())
    assert [c for c in out.columns if c in DROPPED] == []
    for c in CLOCK:
        assert f"{c}Min" in out.columns
    assert "ArrDelayCubeRoot" in out.columns
    assert out.count() == 6000 - 142
    # DepDelay nulls are filled with the mean over all 6000 rows (before the label filter)
    filled = out.where(F.abs(F.col("DepDelay") - F.lit(0.415191)) < 1e-6).count()
    assert filled > 0
    assert out.where(F.col("TailNum").isNull()).count() == 0
    for c in CATEGORICAL:
        assert dict(out.dtypes)[c] == "string"


def test_preprocess_categorical(fx):
    out = clean.preprocess(fx, FeatureSpec(time_mode="categorical"))
    vals = {r[0] for r in out.select("DepTimeDisc").distinct().collect()}
    assert vals <= {"Morning", "Afternoon", "Evening", None}
    assert None in vals  # "NA" clock text stays null in the bare operator
