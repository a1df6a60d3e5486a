"""Sharding by global byte-size prefix sums.

Rows are put in one global order. Range buckets give per-bucket byte and row
totals; the running sum of the totals is each bucket's offset; a running sum
inside the bucket gives every row its global byte position. Cutting positions
at equal targets yields contiguous shards of nearly equal size. Only the key,
size and checksum of a row are shuffled, never its text, and no task sees more
than one bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.common import cut, lookup_join, numbered, range_buckets, shuffle_partitions
from tabreg.sources.scratch import keep, scoped

ROW_BYTES = 8


def shard_by_bytes(docs: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text",
                   row_bytes: int = ROW_BYTES, n_buckets: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``key``, size, text_crc32, shard, slot.

    size is the text's UTF-8 bytes plus ``row_bytes`` (null text: no bytes,
    checksum of the empty text). A row belongs to the shard in which its middle
    byte falls, so every shard is within one row of total / n_shards. slot
    counts the rows of a shard from 0 in key order. Null keys come first; rows
    with equal keys are ordered by checksum and size, and equal rows share a
    result up to their order. An empty table gives no rows. Further columns of
    ``docs`` are not read. Python-free.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be 1 or more")
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    sized = cut(docs.select(F.col(key).alias("_key"), *_measures(body, row_bytes)), "shard-sizes")
    rows = range_buckets(sized, "_key", "_bucket", n_buckets or 4 * shuffle_partitions(spark))
    offsets = _offsets(rows.groupBy("_bucket").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")))
    inside = Window.partitionBy("_bucket").orderBy(F.col("_key").asc_nulls_first(), "text_crc32", "size")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (rows.join(F.broadcast(offsets), "_bucket")
              .withColumn("_start", F.col("_byte0") + F.sum("size").over(running) - F.col("size"))
              .withColumn("_index", F.col("_row0") + F.row_number().over(inside) - 1)
              .withColumn("shard", _shard(n_shards)).select("_key", "size", "text_crc32", "shard", "_index"))
    return _slots(cut(placed, "shard-rows"), key)


@scoped
def shard_texts_by_bytes(docs: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text",
                         row_bytes: int = ROW_BYTES, n_buckets: int | None = None) -> DataFrame:
    """As ``shard_by_bytes``, in the order of the text's hash, then the key: equal texts lie next to each other.

    Equal texts share a shard unless a cut falls between them; so at most
    n_shards - 1 groups of copies are spread, and none needs more shards than
    its bytes do. Keys can be of any type that sorts; nulls come first among
    copies, null and empty texts count as equal, and rows equal in text and key
    are put in any order. Groups are summed before they are ordered; the copies
    of a group are numbered by ranges, so that one of any size is dealt to many
    tasks. Other cases are those of ``shard_by_bytes``. Python-free.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be 1 or more")
    body = F.coalesce(F.col(text), F.lit(""))
    sized = cut(docs.select(F.col(key).alias("_key"), F.xxhash64(body).alias("_hash"), *_measures(body, row_bytes),
                            F.monotonically_increasing_id().alias("_row")), "shard-sizes")
    group, n = ["_hash", "size", "text_crc32"], n_buckets or 4 * shuffle_partitions(docs.sparkSession)
    # hashes spread evenly, so equal ranges of them hold about equally many groups
    bucket = F.least(F.lit(n - 1), F.floor((F.col("_hash").cast("double") / F.lit(2.0 ** 64) + 0.5) * n).cast("int"))
    groups = cut(sized.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.min("_key").alias("_key"))
                 .withColumn("_bucket", bucket), "shard-groups")
    offsets = _offsets(groups.groupBy("_bucket").agg(F.sum(F.col("_n") * F.col("size")).alias("_bytes"), F.sum("_n").alias("_rows")))
    so_far = Window.partitionBy("_bucket").orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    groups = cut(groups.join(F.broadcast(offsets), "_bucket")
                 .withColumn("_start", F.col("_byte0") + F.coalesce(F.sum(F.col("_n") * F.col("size")).over(so_far), F.lit(0)))
                 .withColumn("_index", F.col("_row0") + F.coalesce(F.sum("_n").over(so_far), F.lit(0)))
                 .select("_key", *group, "_n", "_start", "_index", "_all"), "shard-starts")
    repeated = groups.where("_n > 1").select(*group, "_start", "_index", "_all")
    copies = cut(lookup_join(sized, repeated, group, repeated.count(), "inner"), "shard-copies")
    copies = (numbered(copies, ["_key"], "_at", group)
              .withColumn("_start", F.col("_start") + F.col("_at") * F.col("size"))
              .withColumn("_index", F.col("_index") + F.col("_at")))
    columns = ["_key", "size", "text_crc32", "_start", "_index", "_all"]
    placed = cut(groups.where("_n = 1").select(*columns).unionByName(copies.select(*columns))
                 .withColumn("shard", _shard(n_shards)).select("_key", "size", "text_crc32", "shard", "_index"), "shard-rows")
    keep(placed)
    return _slots(placed, key)


def _measures(body, row_bytes: int) -> list:
    return [(F.octet_length(body) + F.lit(row_bytes)).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32")]


def _offsets(totals: DataFrame) -> DataFrame:
    """Bytes and rows before each bucket, and all bytes, from the buckets' totals."""
    # one row per bucket: the only window without a partition key, over n_buckets rows
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return totals.select("_bucket", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte0"),
                         F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"),
                         F.sum("_bytes").over(every).alias("_all"))


def _shard(n_shards: int):
    """The shard in which a row's middle byte falls."""
    return F.least(F.lit(n_shards - 1).cast("long"), F.expr(
        f"((2 * _start + size) * {n_shards}L) div greatest(2 * _all, 1L)")).cast("int")


def _slots(placed: DataFrame, key: str) -> DataFrame:
    first = placed.groupBy("shard").agg(F.min("_index").alias("_first"))  # n_shards rows at most
    return (placed.join(F.broadcast(first), "shard")
            .select(F.col("_key").alias(key), "size", "text_crc32", "shard",
                    (F.col("_index") - F.col("_first")).cast("long").alias("slot")))
