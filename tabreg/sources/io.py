"""Table sources and sinks: raw CSV, Parquet, read-through materialisation."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash_unit
from . import fs


def raw_schema(columns: Sequence[str]) -> T.StructType:
    """All-string, all-nullable schema for a raw CSV with these columns."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_raw(spark: SparkSession, path: str | Sequence[str],
             columns: Sequence[str] | None = None) -> DataFrame:
    """Read a CSV file or folder with a header row; every column is string.

    A folder is read as the union of its files. An empty field is null; the
    text ``NA`` stays the string "NA". With ``columns`` the schema is given
    up front (no header-sniffing job, and the scan can prune columns);
    without it the header names the columns and every type is string.
    """
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    if columns is not None:
        # With an explicit schema, column order must follow the file's header.
        reader = reader.schema(raw_schema(columns)).option("enforceSchema", "false")
    return reader.csv(path if isinstance(path, str) else list(path))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write a DataFrame as CSV with a header row (nulls as empty fields)."""
    df.write.mode(mode).option("header", "true").csv(path)
    return path


def write_table(df: DataFrame, path: str, mode: str = "errorifexists",
                partition_by: Sequence[str] | None = None) -> str:
    """Write Parquet. The default refuses to overwrite an existing path."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet table (file or folder)."""
    return spark.read.parquet(path)


def read_or_build(spark: SparkSession, path: str,
                  builder: Callable[[], DataFrame], inputs: Sequence[str] | None = None) -> DataFrame:
    """Read the Parquet table at ``path``; if it is missing, build, write, read.

    With ``inputs`` (files or folders the builder reads) the table belongs to
    their present content: it lies under ``path`` in a folder named by a stamp
    of their files (names, lengths, times of change). New, changed or removed
    files give another stamp, so the table is built anew, and tables of earlier
    stamps are removed once the new one is complete. Files that change while
    the builder runs leave no table under either stamp: that raises.

    The result is always the table read back from storage, so later stages
    start from Parquet (typed, prunable, pushdown-able) instead of
    re-running the builder's lineage, and a lost executor recomputes from
    the written files. The table is built beside ``path`` and renamed when it
    is complete, so a broken build leaves nothing under the name; of two
    builders the first to finish wins. A folder without Spark's success marker
    is not a table of this function and raises.
    """
    root = path = path.rstrip("/")
    if inputs is not None:
        stamp = fs.stamp(spark, inputs)
        path = f"{root}/inputs-{stamp}"
    if not fs.exists(spark, path):
        built = write_table(builder(), f"{path}.building-{uuid.uuid4().hex[:12]}")
        if inputs is not None and fs.stamp(spark, inputs) != stamp:
            fs.remove(spark, built)
            raise ValueError(f"the input of {root} changed while it was read")
        fs.publish(spark, built, path)
        if inputs is not None:
            for name in fs.children(spark, root):
                if name.startswith("inputs-") and ".building-" not in name and name != f"inputs-{stamp}":
                    fs.remove(spark, f"{root}/{name}")
    if not fs.is_complete(spark, path):
        raise ValueError(f"{path} has no _SUCCESS marker: an unfinished or foreign folder; remove it to build the table")
    return read_table(spark, path)


def preview(df: DataFrame, n: int = 100, fraction: float | None = None,
            seed: int = 1234, keys: Sequence[str] | None = None) -> DataFrame:
    """``n`` rows, optionally of a ``fraction`` sample, as a DataFrame.

    Without ``keys``: a Bernoulli sample and any ``n`` rows (the original's
    ``sample(...).show(n)``). With ``keys``: a keyed-hash sample and the
    first ``n`` rows in key order, the same rows on every run and layout;
    Spark plans it as a per-partition top-n, not a full sort. The library
    never prints; the caller decides to ``show`` or write it.
    """
    if keys:
        if fraction is not None:
            df = df.where(hash_unit(*keys, salt=str(seed)) < F.lit(float(fraction)))
        return df.orderBy(*keys).limit(n)
    if fraction is not None:
        df = df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column, type) rows for the columns of ``df``.

    Built from the analysed schema only; no data is read.
    """
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")
