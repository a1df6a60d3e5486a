"""Keyed hashes for repeatable sampling, splitting and fold assignment.

A row's side of a split depends only on its key values, never on the
partition it sits in or the number of executors, so a rerun on a different
cluster picks the same rows. The hash is the first 32 bits of the md5 of
the keys joined with '-' (each key cast to string, nulls skipped), which
any SQL engine with md5 can recompute.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_POW_32 = 4294967296.0


def _key_text(keys, salt: str | None) -> Column:
    parts = [F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]
    if salt is not None:
        parts = [F.lit(str(salt))] + parts
    return F.concat_ws("-", *parts)


def hash32(*keys, salt: str | None = None) -> Column:
    """Unsigned 32-bit hash of the keys, as bigint."""
    if not keys:
        raise ValueError("hash32 needs at least one key column")
    return F.conv(F.substring(F.md5(_key_text(keys, salt)), 1, 8), 16, 10).cast("bigint")


def hash_unit(*keys, salt: str | None = None) -> Column:
    """Hash of the keys mapped to [0, 1)."""
    return hash32(*keys, salt=salt) / F.lit(_TWO_POW_32)


def hash_bucket(*keys, buckets: int = 100, salt: str | None = None) -> Column:
    """Hash of the keys mapped to 0 .. buckets-1."""
    return hash32(*keys, salt=salt) % F.lit(int(buckets))
