"""String index of columns with any number of categories.

``StringIndexer`` holds every label on the driver and in every task. Here the
index is a table: categories are counted, dealt by ranges of (count
descending, value), numbered inside their range from an offset that the
counts of the ranges before give, and joined back to the rows. Only one number
for each range meets in one task, and no label reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import io, scratch

#: Index tables of up to so many counted rows are broadcast; larger ones are joined by shuffles.
BROADCAST_ROWS = 200_000
#: Over so many tasks the rows of one frequent category are dealt in a shuffled join.
SALT = 8


@dataclass
class StringIndex:
    """``table``: value, index (from 0.0, most frequent first, ties by value); ``size``: its rows, and the index of all else."""
    column: str
    table: DataFrame
    size: int

    def transform(self, df: DataFrame, output: str | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
        """``df`` with ``output``; null and values not seen at fit time get the index ``size``.

        Beyond ``limit`` rows the join is shuffled, whatever size the planner
        takes the table for: the files are small, but their rows are copied
        for each salt. The rows of a value go to ``SALT`` tasks, so null values
        and those of hot categories never gather in one task.
        """
        output = output or f"{self.column}Index"
        value = F.col(f"`{self.column}`").cast("string")
        rows = df.select(F.struct("*").alias("_row"), value.alias("_value"))
        known = self.table.select(F.col("value").alias("_known"), F.col("index").alias("_index"))
        on = F.col("_value") == F.col("_known")
        if self.size <= limit:
            known = F.broadcast(known)
        else:
            rows = rows.withColumn("_salt", F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(SALT)))
            # nulls match nothing: they are spread over values that no category has
            rows = rows.withColumn("_salt", F.when(F.col("_value").isNull(), -1 - F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(4096)))
                                   .otherwise(F.col("_salt")))
            known = known.withColumn("_copy", F.explode(F.array(*[F.lit(i) for i in range(SALT)]))).hint("merge")
            on = on & (F.col("_salt") == F.col("_copy"))
        index = F.coalesce("_index", F.lit(float(self.size))).alias(output)
        keep = [F.col(f"_row.`{c}`") for c in df.columns if c != output]
        return rows.join(known, on, "left").select(*keep, index)

    def save(self, path: str) -> str:
        """The table as Parquet, in index order within its files."""
        return io.write_table(self.table, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, column: str) -> StringIndex:
        table = io.read_table(spark, path)
        return cls(column, table, table.count())


@scratch.scoped
def fit_string_index(df: DataFrame, column: str, partitions: int | None = None) -> StringIndex:
    """Count the categories of ``column`` in ``df`` and rank them.

    Null is no category. A table without values gives an empty index, in which
    everything is unseen. Values are compared as text, ties in UTF-8 order.
    The fitted table is written below the checkpoint folder.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    value = F.col(f"`{column}`").cast("string").alias("value")
    counts = df.select(value).where("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("value")]
    ranged = scratch.cut(counts.repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn("at", F.monotonically_increasing_id()), "index-ranges")
    ranged = ranged.withColumn("range", F.shiftright("at", 33))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("range").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))  # a row for each range
               .withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0))).select("range", "first", "offset"))
    table = ranged.join(F.broadcast(offsets), "range").select(
        "value", (F.col("offset") + F.col("at") - F.col("first")).cast("double").alias("index"))
    table = scratch.cut(table, "index")
    scratch.keep(table)
    return StringIndex(column, table, table.count())
