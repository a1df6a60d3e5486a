"""Registered queries: one per operator, each with its DuckDB oracle.

Every query reads the given tables (through the flight projection where the
operator works on flights) and runs over the whole table. Doubles are
rounded the same way on both sides so the order-insensitive value hash
compares values, not summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        prev = QUERIES.get(name)
        if prev is not None and (prev.__module__, prev.__qualname__) != (fn.__module__, fn.__qualname__):
            raise KeyError(f"query {name!r} registered by two functions")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def hash32_sql(keys, salt: str | None = None) -> str:
    """DuckDB form of ``functions.hashing.hash32``: first 32 bits of md5 of the keys."""
    parts = ([f"'{salt}'"] if salt is not None else []) + [f"cast({k} as varchar)" for k in keys]
    return f"('0x' || substr(md5(concat_ws('-', {', '.join(parts)})), 1, 8))::bigint"


def round_doubles(df: DataFrame, digits: int = 6, only: list[str] | None = None) -> DataFrame:
    """Round every double column (or the named ones) to ``digits`` places."""
    names = [f.name for f in df.schema.fields
             if isinstance(f.dataType, T.DoubleType) and (only is None or f.name in only)]
    return df.withColumns({c: F.round(F.col(c), digits) for c in names}) if names else df
