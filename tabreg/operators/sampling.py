"""Bounded sampling, train/test split and fold assignment.

The keyed forms decide each row from a hash of its key columns, so results
do not depend on partitioning, executor count or retries (a recomputed
partition after an executor loss selects the same rows). The Bernoulli
forms match Spark's ``sample`` / ``randomSplit`` for callers who want them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket, hash_unit
from ..spec import SAMPLE_CAP, SAMPLE_SEED


def sample_fraction(n_rows: int, max_rows: int) -> float:
    """Fraction that gives ``max_rows`` rows on average, never above 1."""
    if n_rows <= 0:
        return 1.0
    return min(1.0, float(max_rows) / float(n_rows))


def bounded_sample(df: DataFrame, max_rows: int = SAMPLE_CAP,
                   keys: Sequence[str] | None = None, seed: int = SAMPLE_SEED,
                   n_rows: int | None = None) -> DataFrame:
    """Sample without replacement, about ``max_rows`` rows (expected, not exact).

    The row count is one aggregate job (skipped if ``n_rows`` is known). A
    table smaller than the cap comes back whole. With ``keys`` the choice is
    a keyed hash salted with the seed; without, Spark's Bernoulli sampler.
    """
    n = df.count() if n_rows is None else n_rows
    fraction = sample_fraction(n, max_rows)
    if fraction >= 1.0:
        return df
    if keys:
        return df.where(hash_unit(*keys, salt=str(seed)) < F.lit(fraction))
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def split_column(keys: Sequence[str], train_percent: int = 80,
                 salt: str | None = None, train: str = "train", test: str = "test") -> Column:
    """'train' / 'test' label from a keyed hash (bucket < train_percent)."""
    return F.when(hash_bucket(*keys, buckets=100, salt=salt) < F.lit(int(train_percent)),
                  F.lit(train)).otherwise(F.lit(test))


def train_test_split(df: DataFrame, keys: Sequence[str] | None = None,
                     weights: Sequence[float] = (0.8, 0.2), seed: int | None = None,
                     salt: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split into (train, test).

    With ``keys``: keyed hash, the same rows on every run and every layout;
    weights must give a whole percent. Without: ``randomSplit`` with the
    seed (the original's unseeded behaviour when ``seed`` is None).
    """
    if keys:
        total = float(sum(weights))
        pct = round(100.0 * weights[0] / total)
        if abs(pct - 100.0 * weights[0] / total) > 1e-9:
            raise ValueError("keyed split needs the train weight to be a whole percent")
        bucket = hash_bucket(*keys, buckets=100, salt=salt)
        return df.where(bucket < F.lit(pct)), df.where(bucket >= F.lit(pct))
    parts = df.randomSplit(list(weights), seed) if seed is not None else df.randomSplit(list(weights))
    return parts[0], parts[1]


def fold_column(keys: Sequence[str], k: int, salt: str = "fold") -> Column:
    """Fold number 0 .. k-1 from a keyed hash (independent of the split)."""
    return hash_bucket(*keys, buckets=k, salt=salt).cast("int")
