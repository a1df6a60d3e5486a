"""Benchmark passages in documents, by a prefix-filtered join.

A benchmark item is cut into windows of ten words. Shingles of three words
are ordered by how often the documents have them. A document that holds a
window holds all its shingles, so the prefix of a window that must be joined
is its single rarest shingle; windows whose rarest shingle no document has are
gone before the join. A shared shingle gives the place the window would start
at; bounds on that place and on the lengths come first, then the words of the
place and of the window are compared exactly.

Documents send on only places whose shingle passes a bit filter of the
benchmark's (of bounded size, whatever the benchmark's), with the words around
them, so no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.common import BROADCAST_ROWS, cut, lookup_join, sized
from tabreg.llm.suffix_tree_lm import _filter_of, _Lookup
from tabreg.llm.textnum import WordHashes, mix, slices
from tabreg.sources.scratch import drop, keep, scoped

WINDOW = 10
SHINGLE = 3
SLICE_CHARS = 2_000_000
_K = np.uint64(0x9E3779B97F4A7C15)
#: A-Z lower-cased; other ASCII that is no letter or digit parts words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_HASHES = WordHashes()


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A number for each stretch of ``width`` words (of one list of words)."""
    n = max(0, len(hashes) - width + 1)
    out = np.full(n, np.uint64(width))
    for j in range(width):
        out = mix(out * _K + hashes[j:j + n])
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _windows(items: DataFrame, key: str, text: str, window: int, shingle: int) -> DataFrame:
    """item, window (words), n (their number), width, shingles of every window of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_CHARS, 0, 1):
            cols = [[] for _ in range(5)]
            for item, text in part:
                words = words_of(text)
                hashes = _HASHES.array(words)
                m = min(window, len(words))
                width = min(shingle, m)
                own = shingles(hashes, width) if m else None
                for at in range(len(words) - m + 1 if m else 0):
                    for c, v in zip(cols, (item, b" ".join(words[at:at + m]).decode(), m, width, _signed(own[at:at + m - width + 1]))):
                        c.append(v)
            types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["item", "window", "n", "width", "shingles"])

    return (items.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, "item string, window string, n int, width int, shingles array<long>"))


def _filter(keys: DataFrame):
    """A broadcast bit filter of 16 MB at most."""
    none = np.zeros(0, np.uint64)
    return keys.sparkSession.sparkContext.broadcast(_Lookup(none, none.astype(float), *_filter_of(keys)))


def _frequencies(docs: DataFrame, text: str, widths: list[int], known) -> DataFrame:
    """shingle, times: counts over all documents of the shingles that pass the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_CHARS, 0):
            found = [np.zeros(0, np.uint64)]
            for (t,) in part:
                hashes = _HASHES.array(words_of(t))
                for width in widths:
                    s = shingles(hashes, width)
                    found.append(s[known.value.maybe(s)])
            s, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(s)), pa.array(n.astype(np.int64))], names=["shingle", "times"])

    return (docs.select(F.col(text).alias("text")).mapInArrow(run, "shingle long, times long")
            .groupBy("shingle").agg(F.sum("times").alias("times")))


def _places(docs: DataFrame, key: str, text: str, widths: list[int], window: int, known) -> DataFrame:
    """key, n_words, places (pos, shingle, lead, around: the words before and from pos) of every document."""
    kind = docs.schema[key].dataType.simpleString()
    place = pa.list_(pa.struct([("pos", pa.int64()), ("shingle", pa.int64()), ("lead", pa.int32()), ("around", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type = None

        def seen():
            nonlocal key_type
            for b in batches:
                key_type = b.schema.field(0).type
                yield b
        for part in slices(seen(), SLICE_CHARS, 0, 1):
            sizes, places = [], []
            for _, t in part:
                words = words_of(t)
                hashes, own = _HASHES.array(words), []
                for width in widths:
                    s = shingles(hashes, width)
                    for pos in np.flatnonzero(known.value.maybe(s)).tolist():
                        lo = max(0, pos - window + 1)
                        own.append(dict(pos=pos, shingle=int(s[pos].view(np.int64)), lead=pos - lo,
                                        around=[w.decode() for w in words[lo:pos + window]]))
                sizes.append(len(words))
                places.append(own)
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in part], key_type), pa.array(sizes, pa.int64()), pa.array(places, place)],
                                             names=["key", "n_words", "places"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, n_words long, places array<struct<pos:long,shingle:long,lead:int,around:array<string>>>")


@scoped
def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, limit: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``key``, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII
    characters. An item's windows are its stretches of ``window`` words, or all
    its words if they are fewer. n_hit counts the document's words inside any
    occurrence of a window, n_items the items with an occurring window, and
    items_sha256 digests their ids, as text in order, joined by commas.
    A null or empty text has no words, an item without words no windows. Items
    with a null id count for n_hit and have no id to name; rows of one id are
    one item. Repeated documents each get a row, null keys too. Without
    documents there are no rows, without items no hits. Further columns are
    not read. Tables of up to ``limit`` rows are broadcast, larger ones joined
    by shuffles, with frequent keys dealt to several tasks.
    """
    if not 1 <= shingle <= window:
        raise ValueError("shingle must be from 1 to window")
    cuts = cut(_windows(benchmark, item, item_text, window, shingle), "decon-windows")
    # one row per different window, and the items that have it
    wid = F.unhex(F.md5("window")).alias("wid")
    owners = cut(cuts.where("item is not null").select(wid, "item").distinct(), "decon-owners")
    n_owners = owners.count()
    different = cut(cuts.dropDuplicates(["window"]).select(wid, "window", "n", "width", "shingles"), "decon-different")
    widths = sorted(r["width"] for r in different.select("width").distinct().collect())  # 1 to ``shingle``

    known = _filter(different.select(F.explode("shingles").alias("shingle")).distinct())
    times = cut(_frequencies(docs, text, widths, known), "decon-times")
    known.destroy()
    parts = different.select("wid", F.posexplode("shingles").alias("offset", "shingle"))
    rarest = (parts.join(sized(times, times.count(), limit), "shingle", "left")
              .groupBy("wid").agg(F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "shingle", "offset")).alias("x"))
              .where("x.times > 0").select("wid", F.col("x.shingle").alias("shingle"), F.col("x.offset").alias("offset")))
    prefix = cut(rarest.join(different.select("wid", "window", "n"), "wid"), "decon-prefix")
    n_prefix = prefix.count()
    drop(cuts, different, times)

    known = _filter(prefix.select("shingle").distinct())
    rows = cut(_places(docs, key, text, widths, window, known).withColumn("row", F.monotonically_increasing_id()), "decon-rows")
    known.destroy()
    places = rows.where(F.size("places") > 0).select("row", "n_words", F.explode("places").alias("p")).select("row", "n_words", "p.*")
    begin = F.col("pos") - F.col("offset")
    held = (lookup_join(places, prefix, ["shingle"], n_prefix, "inner", limit=limit)
            .where((begin >= 0) & (begin + F.col("n") <= F.col("n_words")))
            .where(F.array_join(F.slice("around", F.col("lead") - F.col("offset") + 1, F.col("n")), " ") == F.col("window"))
            .select("row", begin.alias("begin"), (begin + F.col("n")).alias("end"), "wid"))
    held = cut(held, "decon-held")

    earlier = Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.greatest("begin", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    hit = (held.select("row", "begin", "end").distinct().withColumn("new", F.greatest(F.lit(0), F.col("end") - reach))
           .groupBy("row").agg(F.sum("new").alias("n_hit")))
    # documents with the same windows have the same items
    sets = held.groupBy("row").agg(F.sort_array(F.collect_set("wid")).alias("wids"))
    sets = cut(sets.withColumn("set", F.sha2(F.array_join(F.transform("wids", lambda w: F.hex(w)), ","), 256)).join(hit, "row"), "decon-sets")
    members = sets.dropDuplicates(["set"]).select("set", F.explode("wids").alias("wid"))
    named = (members.join(sized(owners, n_owners, limit), "wid").select("set", "item").distinct()
             .groupBy("set").agg(F.sort_array(F.collect_list("item")).alias("items")))
    named = cut(named.select("set", F.size("items").cast("long").alias("n_items"),
                             F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")), "decon-items")
    hits = cut(lookup_join(sets.select("row", "n_hit", "set"), named, ["set"], named.count(), limit=limit).drop("set"), "decon-hits")
    drop(held, sets, named, owners, prefix)
    keep(rows, hits)
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (rows.select("row", "key", "n_words").join(sized(hits, hits.count(), limit), "row", "left")
            .select(F.col("key").alias(key), "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated")))


def oracle_sql() -> str:
    """The same by comparing every window of every document."""
    def words(table, key):
        return f"""select {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from {table}"""
    return f"""
    with i as ({words('benchmark', 'item_id')}),
    iw as (select distinct item_id, n, array_to_string(w[b:b + n - 1], ' ') as win from (
        select item_id, w, least(10, len(w)) as n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) as b from i where len(w) > 0)),
    d as ({words('documents', 'doc_id')}),
    dw as (select doc_id, b, n, array_to_string(w[b:b + n - 1], ' ') as win from (
        select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as b from d, (select distinct n from iw) where len(w) >= n)),
    h as (select dw.doc_id, dw.b, dw.n, iw.item_id from dw join iw on dw.win = iw.win and dw.n = iw.n),
    c as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(b, b + n - 1)) as p from h) group by doc_id),
    s as (select doc_id, count(*) as n_items, sha256(string_agg(id, ',' order by id)) as items_sha256
          from (select distinct doc_id, cast(item_id as varchar) as id from h) group by doc_id)
    select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join c using (doc_id) left join s using (doc_id)"""
