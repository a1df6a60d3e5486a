"""Golden micro-tables for the column expressions."""

import math

import pytest
from pyspark.sql import functions as F

from tabreg.functions import cube_root, day_part, hash_bucket, hhmm_to_minutes


def _one_col(spark, values, dtype="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, t {dtype}")


def test_hhmm_golden(spark):
    # the text rule: last two digits are minutes, the rest hours
    cases = [(5.0, 5), (45.0, 45), (741.0, 461), (2400.0, 1440), (0.0, 0), (2359.9, 1439),
             (-5.0, -5), (-545.0, -255), (-12.0, None), (None, None), (float("nan"), 0),
             (1275.0, 795), (-1000.0, -600)]
    df = _one_col(spark, [c[0] for c in cases])
    got = dict(df.select("i", hhmm_to_minutes("t").alias("m")).collect())
    for i, (_, want) in enumerate(cases):
        assert got[i] == (None if want is None else float(want)), cases[i]


def test_hhmm_reads_text(spark):
    df = spark.createDataFrame([("741",), ("NA",), (None,), ("5",)], "t string")
    assert [r[0] for r in df.select(hhmm_to_minutes("t")).collect()] == [461.0, None, None, 5.0]


def test_day_part_edges(spark):
    cases = [(0.0, "Evening"), (0.5, "Evening"), (1.0, "Morning"), (1125.0, "Morning"),
             (1125.5, "Afternoon"), (1126.0, "Afternoon"), (1750.0, "Afternoon"),
             (1751.0, "Evening"), (float("nan"), "Evening"), (None, None)]
    df = _one_col(spark, [c[0] for c in cases])
    got = dict(df.select("i", day_part("t").alias("d")).collect())
    assert [got[i] for i in range(len(cases))] == [c[1] for c in cases]


def test_cube_root_sign(spark):
    df = _one_col(spark, [-8.0, 27.0, None])
    got = [r[0] for r in df.orderBy("i").select(cube_root("t")).collect()]
    assert got[0] == pytest.approx(-2.0) and got[1] == pytest.approx(3.0) and got[2] is None


def test_hash_bucket_independent_of_partitioning(spark):
    df = spark.range(0, 5000).withColumn("k2", F.col("id") % 7)
    a = df.select("id", hash_bucket("id", "k2", buckets=100).alias("b"))
    b = df.repartition(13).select("id", hash_bucket("id", "k2", buckets=100).alias("b"))
    assert sorted(a.collect()) == sorted(b.collect())
    counts = [r["count"] for r in a.groupBy("b").count().collect()]
    assert len(counts) == 100 and min(counts) > 20 and not math.isnan(sum(counts))
