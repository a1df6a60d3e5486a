"""Sources and sinks: CSV folder union, Parquet sink refusal, read-through."""

import os

import pytest
from pyspark.errors import AnalysisException

from tabreg.plans.fixtures import RAW_COLUMNS, flights
from tabreg.session import shared_dir
from tabreg.sources import io
from conftest import SF0001


def test_csv_folder_is_union_and_keeps_na(spark):
    fx = flights(spark, SF0001, keep_keys=False)
    path = shared_dir(spark, "t-csv")
    io.write_csv(fx.repartition(3), path)  # three files in one folder
    back = io.read_raw(spark, path, columns=RAW_COLUMNS)
    assert back.count() == 6000 and all(t == "string" for _, t in back.dtypes)
    assert back.where("TailNum = 'NA'").count() == 640
    assert back.where("TailNum is null").count() == 545
    assert back.where("CancellationCode is null").count() == 6000
    # header-only read names the columns itself
    assert io.read_raw(spark, path).columns == list(RAW_COLUMNS)


def test_parquet_sink_refuses_existing_path(spark):
    df = spark.range(3)
    path = shared_dir(spark, "t-pq")
    io.write_table(df, path)
    with pytest.raises(AnalysisException):
        io.write_table(df, path)
    assert io.read_table(spark, path).count() == 3


def test_read_or_build_builds_once(spark):
    path = shared_dir(spark, "t-rob")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    a = io.read_or_build(spark, path, build)
    b = io.read_or_build(spark, path, build)
    assert a.count() == b.count() == 5 and len(calls) == 1


def test_read_or_build_refuses_an_unfinished_folder(spark):
    from tabreg.sources import fs
    path = shared_dir(spark, "t-part")
    spark.range(50).write.parquet(path)
    fs.remove(spark, f"{path}/_SUCCESS")
    with pytest.raises(ValueError, match="_SUCCESS"):
        io.read_or_build(spark, path, lambda: spark.range(5))
    broken = shared_dir(spark, "t-broken")
    with pytest.raises(Exception):
        io.read_or_build(spark, broken, lambda: spark.range(5).selectExpr("assert_true(id < 2) as x"))
    assert not fs.exists(spark, broken)  # a failed build leaves nothing under the name
    assert io.read_or_build(spark, broken, lambda: spark.range(5)).count() == 5


def test_load_or_train_leaves_a_damaged_model(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression, LinearRegressionModel
    from tabreg.sources import fs, model_store
    df = VectorAssembler(inputCols=["id"], outputCol="features").transform(spark.range(9).selectExpr("id", "id * 2.0 as label"))
    path = model_store.model_path(shared_dir(spark, "t-model"), "lr", "label", "numeric")
    _, loaded = model_store.load_or_train(path, LinearRegressionModel, lambda: LinearRegression().fit(df))
    assert not loaded
    fs.remove(spark, f"{path}/data")
    calls = []
    with pytest.raises(Exception):
        model_store.load_or_train(path, LinearRegressionModel, lambda: calls.append(1))
    assert not calls and fs.exists(spark, f"{path}/metadata") and not fs.exists(spark, f"{path}/data")


def test_read_or_build_reraises_other_errors(spark):
    path = shared_dir(spark, "t-rob2")
    with pytest.raises(ZeroDivisionError):
        io.read_or_build(spark, path, lambda: 1 / 0)


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "a int, b string, c double")
    rows = io.schema_report(df).collect()
    assert [(r.position, r.column_name, r.data_type) for r in rows] == [(0, "a", "int"), (1, "b", "string"),
                                                                         (2, "c", "double")]


def test_preview(spark):
    assert io.preview(spark.range(1000), n=7).count() == 7
    assert io.preview(spark.range(1000), n=1000, fraction=0.1).count() < 200
    keyed = io.preview(spark.range(1000).repartition(5), n=10, fraction=0.5, keys=["id"])
    again = io.preview(spark.range(1000), n=10, fraction=0.5, keys=["id"])
    assert [r.id for r in keyed.collect()] == [r.id for r in again.collect()]
    from test_plans import plan
    assert "TakeOrderedAndProject" in plan(keyed)  # per-partition top-n, no full sort


def test_read_or_build_notices_its_input(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).write.parquet(source)
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(source)

    def read():
        return io.read_or_build(spark, path, build, [source]).count()
    assert (read(), read(), len(calls)) == (5, 5, 1)
    spark.range(3).write.mode("append").parquet(source)
    assert (read(), read(), len(calls)) == (8, 8, 2)
    assert len([n for n in os.listdir(path) if n.startswith("inputs-")]) == 1  # the older table is gone
    os.remove(next(os.path.join(source, n) for n in sorted(os.listdir(source)) if n.endswith(".parquet")))
    read()
    assert len(calls) == 3
    with pytest.raises(Exception):
        io.read_or_build(spark, path, build, [str(tmp_path / "none")])


def test_read_or_build_refuses_input_that_changes_meanwhile(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).write.parquet(source)

    def build():
        spark.range(2).write.mode("append").parquet(source)
        return spark.range(1)
    with pytest.raises(ValueError, match="changed while"):
        io.read_or_build(spark, path, build, [source])
    assert not os.path.exists(path) or not os.listdir(path)
