"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabreg.sources import scratch

#: Rows up to which a counted lookup table is broadcast; larger ones take the shuffled join.
BROADCAST_ROWS = 200_000


_shipped: set[str] = set()
#: Bytes of rows that go to a Python worker at once, unless the session says otherwise; Spark's 64 MB of long texts
#: are held by the executor's JVM outside of its heap and by the worker, twice each, for every task.
ARROW_BYTES = 8 * 2**20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would, once per application; bound the session's Arrow batches."""
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, ARROW_BYTES)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tabreg-code-"), "tabreg_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.relpath(file, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of ids and numbers that one task may well write.
ROWS_PER_TASK = 250_000


def cut(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    The result has no lineage to recompute, and any executor can read it. The
    enclosing ``scratch.Scratch`` owns the table. ``rows``: a counted bound on
    its rows; a small table is then written by as many tasks as it needs.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))
    return scratch.cut(df, name)


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column ``_doc``, so that no column of theirs can clash; ``_doc.*`` gives them back."""
    return docs.select(F.struct("*").alias("_doc"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_buckets(df: DataFrame, key: str, out: str, n: int) -> DataFrame:
    """Add ``out``: an int bucket that rises with the number ``key``.

    ``n`` buckets of about equal row counts, cut at approximate quantiles
    (one aggregate; n - 1 numbers reach the driver). Equal keys share a
    bucket; nulls share the first one.
    """
    low = float("-inf")
    value = F.coalesce(F.col(key).cast("double"), F.lit(low))
    cuts = df.agg(F.percentile_approx(F.col(key).cast("double"), [i / n for i in range(1, n)] or [0.5],
                                      max(1000, 20 * n)).alias("c")).first()["c"] or []
    cuts = sorted({c for c in cuts if c == c and abs(c) != float("inf")}) or [0.0]
    at = f"_{out}_key"
    return (Bucketizer(splits=[low, *cuts, float("inf")], inputCol=at, outputCol=out, handleInvalid="keep")
            .transform(df.withColumn(at, value)).withColumn(out, F.col(out).cast("int")).drop(at))


def numbered(rows: DataFrame, order: list[str], out: str, part: list[str] | None = None) -> DataFrame:
    """Add ``out``: each row's number from 0 in the rising order of ``order`` within its ``part``, nulls first.

    Rows are dealt by ranges of ``part``, ``order`` and a row number, so that
    no part, and no value that many rows share, gathers in one task; a range's
    first number comes from the counts of the ranges before. ``rows`` must give
    the same rows each time it is run (a written table does). The result is a
    written table.
    """
    part = part or []
    names = {f"_{out}_{x}": x for x in ("row", "at", "task", "first", "before")}
    row, at, task, first, before = names
    n = max(shuffle_partitions(rows.sparkSession), 1)
    ranged = (rows.withColumn(row, F.monotonically_increasing_id())
              .repartitionByRange(n, *part, *order, row).sortWithinPartitions(*part, *order, row)
              .withColumn(at, F.monotonically_increasing_id()).drop(row))
    ranged = cut(ranged, "numbered")
    ranged_task = ranged.withColumn(task, F.shiftright(at, 33))
    ends = ranged_task.groupBy(*part, task).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(before))
    # a row for each range, and one more for each part
    earlier = Window.partitionBy(*part).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    ends = cut(ends.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0))), "numbered-ends")
    done = cut(lookup_join(ranged_task, ends, [*part, task], ends.count())
               .withColumn(out, F.col(before) + F.col(at) - F.col(first)).select(*rows.columns, out), "numbered-rows")
    scratch.drop(ranged, ends)
    return done


def sized(df: DataFrame, n: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` of ``n`` counted rows as a join side: broadcast up to ``limit`` rows, else shuffled."""
    return F.broadcast(df) if n <= limit else df


def lookup_join(rows: DataFrame, small: DataFrame, keys: list[str], n_small: int, how: str = "left",
                salt: int = 8, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join ``rows`` with a table of ``n_small`` counted rows, unique in ``keys``.

    Up to ``limit`` rows the table is broadcast. Beyond it, ``rows`` are spread
    over ``salt`` values and the table is repeated for each, so that a key with
    a third of all rows is dealt to ``salt`` tasks. Null keys match null keys.
    """
    def on(extra):
        cond = None
        for k in [*keys, *extra]:
            c = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
            cond = c if cond is None else cond & c
        return cond

    value_cols = [c for c in small.columns if c not in keys]
    if n_small <= limit:
        out = rows.alias("l").join(F.broadcast(small.alias("r")), on([]), how)
    else:
        left = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salt)).cast("int"))
        right = small.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salt)])))
        out = left.alias("l").join(right.alias("r"), on(["_salt"]), how)
    return out.select([F.col(f"l.{c}") for c in rows.columns] + [F.col(f"r.{c}") for c in value_cols])
