"""Bottom-k document fingerprints.

A fingerprint is the k smallest distinct 64-bit hashes of a text's word
shingles, in rising order. Fingerprints of parts merge into the fingerprint of
the whole, and two of them estimate resemblance, containment and the number of
distinct shingles. Built from SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.common import range_buckets, shuffle_partitions

K = 128
SHINGLE = 5
_SPAN = float(2**64)
_LOW = float(-(2**63))


def words(text: Column) -> Column:
    """Lower-cased words between white space; null and blank texts have none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")


def with_fingerprints(df: DataFrame, cols: dict[str, str], k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Add a fingerprint (array of long) for each text column: {out: text column}.

    A text with fewer than ``shingle`` words has one shingle of all its words;
    a null or blank text has an empty fingerprint. Each step is a projection of
    its own, so that no step is evaluated once per element of the next.
    """
    out = df.withColumns({f"_h_{c}": F.transform(words(F.col(t)), lambda w: F.xxhash64(w)) for c, t in cols.items()})

    def shingles(h):
        return F.when(F.size(h) >= shingle, F.transform(
            F.slice(h, 1, F.greatest(F.size(h) - (shingle - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, shingle)]))).when(
            F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    out = out.withColumns({f"_s_{c}": shingles(F.col(f"_h_{c}")) for c in cols})
    out = out.withColumns({c: F.slice(F.array_sort(F.array_distinct(f"_s_{c}")), 1, k) for c in cols})
    return out.drop(*[f"_{x}_{c}" for c in cols for x in "hs"])


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The fingerprint of two parts taken together. Nulls count as empty."""
    none = F.array().cast("array<bigint>")
    return F.slice(F.array_sort(F.array_union(F.coalesce(a, none), F.coalesce(b, none))), 1, k)


def merge_groups(df: DataFrame, keys: list[str], fingerprint: str, k: int = K) -> DataFrame:
    """One merged fingerprint per group: keys, fingerprint.

    Every hash is a row and equal hashes meet before they are ranked; the
    ranking keeps k rows of a group in each task before the shuffle, so one
    group may hold any share of the rows. Groups of empty fingerprints keep an
    empty one; null keys form a group.
    """
    rows = df.select(*keys, F.explode_outer(fingerprint).alias("_x")).distinct()
    best = Window.partitionBy(*keys).orderBy(F.col("_x").asc_nulls_last())
    kept = rows.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k)
    return kept.groupBy(*keys).agg(F.array_sort(F.collect_list("_x")).alias(fingerprint))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A ∩ B| / |A ∪ B|, 0 to 1; two empty fingerprints: 1."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union)).cast("double")


def distinct_shingles(f: Column, k: int = K) -> Column:
    """Exact below k; else (k - 1) over the kth smallest hash as a share of the range."""
    top = (F.element_at(f, -1).cast("double") - F.lit(_LOW)) / F.lit(_SPAN)
    return F.when(F.size(f) < k, F.size(f).cast("double")).otherwise((k - 1) / top)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A ∩ B| / |A|, 0 to 1; an empty A: 1."""
    r = resemblance(a, b, k)
    size = distinct_shingles(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(
        F.least(F.lit(1.0), r * distinct_shingles(merge(a, b, k), k) / size))


def as_text(f: Column) -> Column:
    """The hashes as hexadecimal text, 16 digits each, unsigned."""
    return F.array_join(F.transform(f, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def with_next(df: DataFrame, key: str, tie: str, carry: dict[str, str], add=lambda rows: rows,
              n_buckets: int | None = None) -> DataFrame:
    """Add columns of the next row by descending ``key``; the last row's next is the first.

    ``carry``: {new column: column}. ``add`` may add columns to carry, row by
    row; it runs once for each row and guest. Rows are dealt to range buckets; each
    bucket also gets one guest, the first row of the bucket below (or, at the
    end, of the top one), so a window inside the bucket sees every next row.
    Null keys come last; rows with equal keys follow in the order of a hash of
    ``tie``. A single row is its own next.
    """
    n = n_buckets or 3 * shuffle_partitions(df.sparkSession)
    rows = range_buckets(df, key, "_bucket", n).withColumn("_tie", F.xxhash64(tie))
    rank = F.struct(F.col(key).isNotNull().alias("n"), F.col(key).alias("k"), F.col("_tie").alias("t"))
    heads = rows.groupBy("_bucket").agg(F.max(rank).alias("_head"))  # one small row per bucket
    # one row per bucket: windows without a partition key over n_buckets rows
    chain = Window.orderBy("_bucket")
    whole = chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("_bucket", "_head", F.coalesce(
        F.lead("_bucket").over(chain), F.min("_bucket").over(whole)).alias("_to"))
    guests = (rows.join(F.broadcast(heads), "_bucket").where(rank == F.col("_head"))
              .dropDuplicates(["_bucket"])
              .select(*[F.col("_to").alias(c) if c == "_bucket" else F.col(c) for c in rows.columns],
                      F.lit(1).alias("_guest")))
    order = Window.partitionBy("_bucket").orderBy("_guest", F.col(key).desc_nulls_last(), F.col("_tie").desc())
    both = add(rows.withColumn("_guest", F.lit(0)).unionByName(guests))
    out = both.withColumns({new: F.lead(old).over(order) for new, old in carry.items()})
    return out.where("_guest = 0").drop("_guest", "_bucket", "_tie")


def edited_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K,
                 shingle: int = SHINGLE) -> DataFrame:
    """Fingerprint every text, and the text whose second half the next document's start replaces.

    The last floor(n/2) code points give way to the first floor(n/2), or all,
    of the next document by descending ``key``. Returns key, n_chars,
    edited_sha256, fingerprint, edited_fingerprint (text), near_edited,
    near_next and distinct_shingles. Null texts are empty; two empty
    fingerprints resemble each other fully.
    """
    base = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    paired = with_next(base, "_key", "_text", {"_next_text": "_text", "_next_fp": "_fp"},
                       lambda rows: with_fingerprints(rows, {"_fp": "_text"}, k, shingle))
    half = F.floor(F.length("_text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), F.length("_text") - half),
                      F.substring(F.col("_next_text"), F.lit(1), half))
    out = with_fingerprints(paired.withColumn("_edited", edited), {"_edited_fp": "_edited"}, k, shingle)
    return out.select(
        F.col("_key").alias(key), F.length("_text").cast("long").alias("n_chars"),
        F.sha2(F.col("_edited"), 256).alias("edited_sha256"),
        as_text(F.col("_fp")).alias("fingerprint"), as_text(F.col("_edited_fp")).alias("edited_fingerprint"),
        resemblance(F.col("_fp"), F.col("_edited_fp"), k).alias("near_edited"),
        resemblance(F.col("_fp"), F.col("_next_fp"), k).alias("near_next"),
        distinct_shingles(F.col("_fp"), k).alias("distinct_shingles"))
