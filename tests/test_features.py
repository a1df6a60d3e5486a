"""Encoding golden tables: string index, assembler, L1 normaliser."""

import math

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array

from tabreg.operators import features


def test_string_index_golden(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    model = features.string_indexer(["v"]).fit(train)
    assert model.labelsArray == [["c", "a", "b"]]  # frequency, then text
    test = spark.createDataFrame([("c",), ("a",), ("b",), ("z",), (None,)], "v string")
    got = [r[0] for r in model.transform(test).select("vIndex").collect()]
    assert got == [0.0, 1.0, 2.0, 3.0, 3.0]


def _norm(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double")
    out = Pipeline(stages=[features.vector_assembler(["a", "b"]), features.l1_normalizer()]).fit(df).transform(df)
    return [r[0] for r in out.select(vector_to_array("normFeatures")).collect()]


def test_l1_normalize_golden(spark):
    got = _norm(spark, [(2.0, 3.0), (0.0, 0.0), (-1.0, 3.0), (1.0, float("nan")), (1.0, None)])
    assert got[0] == [0.4, 0.6]
    assert got[1] == [0.0, 0.0]
    assert got[2] == [-0.25, 0.75]
    assert all(math.isnan(x) for x in got[3])
    assert all(math.isnan(x) for x in got[4])  # null -> NaN by the assembler, then the row


def test_feature_stages_layout():
    from tabreg.spec import FeatureSpec
    spec = FeatureSpec()
    assert len(spec.feature_names) == 16
    assert spec.feature_names[:9] == tuple(f"{c}Index" for c in spec.categorical)
    assert spec.feature_names[9:] == ("DepDelay", "Distance", "TaxiOut", "DepTimeMin",
                                      "CRSDepTimeMin", "CRSArrTimeMin", "CRSElapsedTimeMin")
    cat = FeatureSpec(time_mode="categorical")
    assert len(cat.feature_names) == 16 and cat.feature_names[9] == "DepTimeDiscIndex"
    stages = features.feature_stages(spec)
    assert [type(s).__name__ for s in stages] == ["Imputer", "StringIndexer", "VectorAssembler", "Normalizer"]
