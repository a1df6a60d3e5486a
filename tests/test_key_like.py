from pyspark.sql import functions as F

from tabreg.operators import features
from tabreg.plans import workflow
from tabreg.plans.fixtures import KEYS
from tabreg.spec import FeatureSpec


def test_key_like_category_is_indexed_by_a_table(spark, fx):
    spec = FeatureSpec()
    prep = workflow.prepare(fx, spec)
    train = prep.where(F.col("l_linenumber") <= 3)
    plain, tables = (features.fit_features(train, spec, least=n) for n in (10**6, 20))
    assert "FlightNum" in features.key_like(train, spec.index_inputs, 20)
    assert not any("FlightNum" in s.getInputCols() for s in tables.stages if hasattr(s, "labelsArray"))
    cols = [*KEYS, *spec.index_outputs]

    def rows(model):
        out = features.vector_columns(model.transform(prep), features.FEATURES, spec.feature_names, keep=KEYS)
        return sorted(map(tuple, out.select(*cols).collect()))
    assert rows(plain) == rows(tables)
