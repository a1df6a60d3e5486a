"""Split and sample invariants."""

from pyspark.sql import functions as F

from tabreg.operators import sampling
from tabreg.plans.fixtures import KEYS


def test_keyed_split_disjoint_covering_stable(spark, fx):
    train, test = sampling.train_test_split(fx, keys=KEYS)
    n, a, b = fx.count(), train.count(), test.count()
    assert a + b == n and 0.75 < a / n < 0.85
    again, _ = sampling.train_test_split(fx.repartition(7), keys=KEYS)
    key = F.concat_ws("-", *KEYS)
    assert sorted(r[0] for r in train.select(key).collect()) == sorted(r[0] for r in again.select(key).collect())


def test_bounded_sample_whole_when_small(fx):
    assert sampling.bounded_sample(fx, max_rows=10_000, keys=KEYS).count() == 6000


def test_bounded_sample_expected_size(fx):
    n = sampling.bounded_sample(fx, max_rows=3000, keys=KEYS).count()
    assert 2700 < n < 3300
    m = sampling.bounded_sample(fx, max_rows=3000).count()  # Bernoulli form
    assert 2700 < m < 3300


def test_bounded_sample_empty(spark):
    df = spark.createDataFrame([], "a int")
    assert sampling.bounded_sample(df, max_rows=10).count() == 0


def test_fold_column_range(fx):
    folds = {r[0] for r in fx.select(sampling.fold_column(KEYS, 5)).distinct().collect()}
    assert folds == {0, 1, 2, 3, 4}
