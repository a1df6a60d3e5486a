"""Near-duplicate groups by DartMinHash signatures and banded joining.

A text is a weighted set: its five-word shingles with their multiplicities.
Darts are thrown by hashing into the regions (element, unit of weight, strip
of rank); a text keeps the darts that fall below its weights, and for each
signature coordinate the dart of lowest rank. Two texts agree in a coordinate
with the probability of their weighted Jaccard similarity. Bands of
coordinates give buckets. Candidates from buckets whose signatures agree as
often as similar texts' do are compared exactly.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.common import cut, sized
from tabreg.llm.components import components
from tabreg.sources.scratch import drop, keep, scoped
from tabreg.llm.textnum import WordHashes, mix, remembers, salted, slices, unit, working

SHINGLE = 5
SIMILARITY = (4, 5)  # 0.8 as a fraction, so that the comparison is exact
BANDS, ROWS = 26, 5
MOST_ROUNDS = 8
#: A bucket with so many pairs for each row, or fewer, is paired; others take leaders. Sketches and marks alone tell nearly all of them apart.
PAIRS_PER_ROW = 100
#: Most pairs of one bucket that are gone through at the end, when all buckets are paired.
MOST_PAIRS = 4_000_000
#: Bits of each signature coordinate in a sketch, and the probability that a pair at the threshold fails by its sketch.
SKETCH_BITS, SKETCH_MISS = 4, 1e-9
#: Marks of a text: so many bits for each unit, rounded up to a power of two, from 64 to so many.
MARK_BITS, MOST_MARKS = 8, 1 << 14
#: Rows of marks up to which they are broadcast.
MARK_ROWS = 20_000
SLICE_CHARS = 1_000_000
#: Rank strips: [0, 2^-5), [2^-5, 2^-4) ... [1/2, 1), then of width 1.
_LOW_STRIPS = 6
_HASHES = WordHashes()
remembers("dartminhash", _HASHES.clear)


def _strip(i: int) -> tuple[float, float]:
    if i >= _LOW_STRIPS:
        return float(i - _LOW_STRIPS + 1), float(i - _LOW_STRIPS + 2)
    return (0.0 if i == 0 else 2.0 ** (i - _LOW_STRIPS)), 2.0 ** (i + 1 - _LOW_STRIPS)


def _poisson_cdf(mean: float) -> np.ndarray:
    p, out = np.exp(-mean), []
    for i in range(24):
        out.append(p)
        p = p * mean / (i + 1)
    return np.cumsum(out)


_CDF = [_poisson_cdf(_strip(i)[1] - _strip(i)[0]) for i in range(_LOW_STRIPS + 1)]


def elements(texts: list[str], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text index, element) of every unit of weight, in rising order per text.

    The nth occurrence of a shingle is its nth unit of weight, so the weighted
    similarity of two texts is the plain one of their units. Words are
    lower-cased runs between white space; a text of fewer than ``shingle``
    words is one shingle, one without words has no elements.
    """
    working("dartminhash")
    words = [_HASHES.array(t.lower().split()) for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    flat = np.concatenate(words) if len(words) else np.zeros(0, np.uint64)
    begin = np.cumsum(n) - n
    units = np.where(n >= shingle, n - shingle + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(texts)), units)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(units) - units, units) + begin[doc]
    out, length = np.zeros(len(doc), np.uint64), n[doc]
    for j in range(shingle):
        there = j < length
        nxt = flat[np.where(there, at + j, 0)] if len(flat) else out
        out = np.where(there, mix(out * np.uint64(0x9E3779B97F4A7C15) + nxt), out)
    order = np.lexsort((out, doc))
    doc, out = doc[order], out[order]
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    group = np.flatnonzero(fresh)
    nth = np.arange(len(out)) - np.repeat(group, np.diff(np.append(group, len(out))))
    out = np.where(nth > 0, mix(out + nth.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), out)
    return doc, out


def signatures(doc: np.ndarray, units: np.ndarray, n_docs: int, k: int, darts: float = 0.0) -> np.ndarray:
    """(n_docs, k) dart ids. ``units`` are elements of unit weight; a document without any has zeros.

    Strips are taken in full up to the rank at which ``darts`` darts are
    expected (k ln k + 2 k). Documents with a coordinate that no dart hit are
    thrown again with twice as many.
    """
    darts = darts or k * np.log(k) + 2 * k
    size = np.bincount(doc, minlength=n_docs)
    reach = darts / np.maximum(size, 1)  # rank up to which darts are needed
    strips = np.where(reach > 1, _LOW_STRIPS + np.ceil(reach - 1),
                      np.clip(np.ceil(np.log2(reach)) + _LOW_STRIPS, 1, _LOW_STRIPS)).astype(np.int64)
    best = np.full(n_docs * k, np.inf)
    out = np.zeros(n_docs * k, np.uint64)

    def throw(doc, units, low, width, cdf, salt):
        cell = mix(units ^ salt)
        hits = np.searchsorted(cdf, unit(cell), side="right")
        some = np.flatnonzero(hits)
        hits = hits[some]
        cell = np.repeat(cell[some], hits)
        nth = np.arange(len(cell)) - np.repeat(np.cumsum(hits) - hits, hits)
        dart = mix(cell + (nth + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        low = np.repeat(low[some], hits) if isinstance(low, np.ndarray) else low
        rank = low + width * unit(dart)
        at = np.repeat(doc[some], hits) * k + (salted(dart, 7) % np.uint64(k)).astype(np.int64)
        np.minimum.at(best, at, rank)
        won = rank == best[at]
        out[at[won]] = dart[won]

    for s in range(_LOW_STRIPS):
        use = strips[doc] > s
        low, high = _strip(s)
        throw(doc[use], units[use], low, high - low, _CDF[s], salted(np.array([s + 1], np.uint64), 3))
    unit_strips = np.maximum(strips - _LOW_STRIPS, 0)[doc]
    cells = np.repeat(np.arange(len(doc)), unit_strips)
    nth = np.arange(len(cells)) - np.repeat(np.cumsum(unit_strips) - unit_strips, unit_strips)
    if len(cells):
        throw(doc[cells], units[cells], nth + 1.0, 1.0, _CDF[_LOW_STRIPS],
              salted((nth + _LOW_STRIPS + 1).astype(np.uint64), 3))
    out = out.reshape(n_docs, k)
    missed = np.flatnonzero(np.isinf(best.reshape(n_docs, k)).any(axis=1) & (size > 0))
    if len(missed):
        place = np.full(n_docs, -1)
        place[missed] = np.arange(len(missed))
        again = place[doc] >= 0
        out[missed] = signatures(place[doc[again]], units[again], len(missed), k, 2 * darts)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n_docs, bands) bucket numbers, different from band to band."""
    key = np.zeros((len(sig), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        key = mix(key * np.uint64(0xD1B54A32D192ED03) + sig[:, r:bands * rows:rows])
    return key.view(np.int64)


def sketches(sig: np.ndarray) -> np.ndarray:
    """(n_docs, words) of 64 bits: bit b of each coordinate side by side, then bit b + 1."""
    low = salted(sig, 11)
    words = -(-sig.shape[1] // 64)
    out = np.zeros((len(sig), SKETCH_BITS * words * 8), np.uint8)
    for b in range(SKETCH_BITS):
        bits = np.packbits(((low >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1)
        out[:, b * words * 8:b * words * 8 + bits.shape[1]] = bits
    return out.view(np.int64)


def least_agreement(k: int, similarity: tuple[int, int], miss: float = SKETCH_MISS) -> int:
    """The most coordinates of ``k`` that a pair at the threshold agrees in but for a probability of ``miss``."""
    s, below = similarity[0] / similarity[1], 0.0
    for n in range(k + 1):
        below += math.comb(k, n) * s**n * (1 - s)**(k - n)
        if below > miss:
            return n
    return k


def _agreeing(x: str, y: str, k: int):
    """The number of the ``k`` coordinates in which the sketches ``x`` and ``y`` agree."""
    words, apart = -(-k // 64), F.lit(0)
    for w in range(words):
        planes = [F.col(x)[b * words + w].bitwiseXOR(F.col(y)[b * words + w]) for b in range(SKETCH_BITS)]
        apart = apart + F.bit_count(functools.reduce(lambda p, q: p.bitwiseOR(q), planes))
    return F.lit(k) - apart


def marks(units: np.ndarray) -> np.ndarray:
    """64-bit words whose bit ``unit`` modulo their number of bits is set for each unit."""
    size = min(max(64, 1 << (MARK_BITS * len(units) - 1).bit_length()), MOST_MARKS)
    out = np.zeros(size, np.uint8)
    out[(units & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").view(np.int64)


def _may_link(similarity: tuple[int, int], mx: str, my: str, nx: str, ny: str):
    """Whether the marks of texts with nx, ny units leave room for as many shared units as a link needs.

    A bit set in one only stands for one unit or more that the other lacks,
    so no link fails here. Marks twice as long are folded to the others' length.
    """
    num, den = similarity

    def folded(x: str, y: str):
        half = (F.size(x) / 2).cast("int")
        return F.when(F.size(x) == 2 * F.size(y), F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseOR(q))).otherwise(F.col(x))

    def lacking(p, q):
        return F.aggregate(F.zip_with(p, q, lambda b, c: F.bit_count(b.bitwiseAND(F.bitwise_not(c)))), F.lit(0), lambda n, b: n + b)
    x, y = folded(mx, my), folded(my, mx)
    shared = F.least(F.col(nx) - lacking(x, y), F.col(ny) - lacking(y, x))
    return (F.size(x) != F.size(y)) | (shared * (num + den) >= (F.col(nx) + F.col(ny)) * num)


def _row_id(key: str, text: str):
    return F.xxhash64(F.col(key), F.col(text))


def _sketches(docs: DataFrame, key: str, text: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """key, row, copy (hash of the word sequence), weight, buckets, sketch for every row."""
    longs = pa.list_(pa.field("element", pa.int64(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def seen():
            nonlocal kind
            for b in batches:
                kind = b.schema.field(0).type
                yield b
        for part in slices(seen(), SLICE_CHARS, 0, 1, 2):
            texts = [p[2] for p in part]
            doc, units = elements(texts, shingle)
            sig = signatures(doc, units, len(texts), bands * rows)
            keys = band_keys(sig, bands, rows)
            copies = [hashlib.blake2b(" ".join(t.lower().split()).encode(), digest_size=16).digest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in part], kind), pa.array([p[1] for p in part], pa.int64()),
                 pa.array(copies, pa.binary()), pa.array(np.bincount(doc, minlength=len(texts)), pa.int64()),
                 pa.array(list(keys), longs), pa.array(list(sketches(sig)), longs)],
                names=["key", "row", "copy", "weight", "buckets", "sketch"])

    rows_in = docs.select(F.col(key).alias("key"), _row_id(key, text).alias("row"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows_in.mapInArrow(run, f"key {kind}, row long, copy binary, weight long, buckets array<long>, sketch array<long>")


def _compare(pairs: DataFrame, n: int, units: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """a, b, linked for each of the ``n`` counted pairs of nodes."""
    num, den = similarity
    both = F.size(F.array_intersect("x", "y"))
    pairs = sized(pairs.select("a", "b"), n)
    return (pairs.join(units.select(F.col("node").alias("b"), F.col("units").alias("y")), "b")
            .join(units.select(F.col("node").alias("a"), F.col("units").alias("x")).join(pairs.select("a"), "a", "left_semi"), "a")
            .select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("all"))
            .select("a", "b", (F.col("both") * (num + den) >= F.col("all") * num).alias("linked")))


def _beside(star: DataFrame, units: DataFrame) -> DataFrame:
    """The rows of ``star`` with both (units shared with the leader) and extra (units the leader lacks)."""
    joined = (star.join(units.select("node", F.col("units").alias("x")), "node")
              .join(units.select(F.col("node").alias("l_node"), F.col("units").alias("y")), "l_node"))
    return (joined.select(*star.columns, F.size("x").alias("n"), F.array_except("x", "y").alias("extra"))
            .select(*star.columns, (F.col("n") - F.size("extra")).cast("long").alias("both"), "extra"))


def _units_of(docs: DataFrame, wanted: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """node, units (64-bit numbers), marks of the wanted (node, key, row)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_CHARS, 0, 1):
            doc, units = elements([p[1] for p in part], shingle)
            ends = np.cumsum(np.bincount(doc, minlength=len(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in part], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(units.view(np.int64))),
                 pa.array([marks(u) for u in np.split(units, ends[:-1])], pa.list_(pa.int64()))],
                names=["node", "units", "marks"])

    rows = docs.select(F.col(key).alias("key"), _row_id(key, text).alias("row"), F.col(text).alias("text")).alias("d")
    found = rows.join(wanted.alias("w"), F.col("d.key").eqNullSafe(F.col("w.key")) & (F.col("d.row") == F.col("w.row")))
    return found.select("node", "text").dropDuplicates(["node"]).mapInArrow(run, "node long, units array<long>, marks array<long>")


@scoped
def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    similarity: tuple[int, int] = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
                    pairs_per_row: int = PAIRS_PER_ROW, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """One row per row of ``docs``: key, row, class_id, class_row.

    Texts are linked if the weighted Jaccard similarity of their shingles is
    ``similarity`` or more; a class is what links connect. class_id is the
    smallest key of the class and (class_id, class_row) names the row that
    represents it. Equal word sequences are one text and are never paired.
    Links are not counted: pairs already in one class are not compared.

    Candidates are the pairs of different classes in a bucket. They are first
    told apart by sketches, a few bits of each signature coordinate: a pair at
    the threshold fails there with a probability of ``SKETCH_MISS``, far less
    than that of sharing no bucket; then by marks, a few bits for each unit,
    which bound the shared units from above, so that no link fails. Only
    the others have their units read and are compared exactly. Every
    bucket has a leader, the member that meets most others. At first each text is
    compared with one leader only, the greatest of its buckets', which settles
    most classes with one comparison a text. Then, bucket by bucket: with at
    most ``pairs_per_row`` pairs for each row, they are compared as they are;
    else the members are compared with the bucket's leader. Two members that
    share no unit outside the leader share at most what each has in common
    with it, which rules out nearly all of them by three numbers; members that
    do share one meet in a bucket of that leader and unit in the next round.
    As soon as all pairs left are at most ``pairs_per_row`` for each row of the
    first buckets, and at most ``MOST_PAIRS`` in any one, or after ``most_rounds`` rounds, which takes leaders within
    leaders, they are compared as they are. So no candidate is given up.
    New links join the classes they connect, so a step's links are pairs of
    classes, not of texts.

    Null and blank texts form one class. Rows with a null key belong to
    classes; class_id is null only where all keys are. Repeated rows each get
    a row. An empty table gives no rows; further columns are not read.
    """
    rows_all = cut(_sketches(docs, key, text, shingle, bands, rows), "dart-sketches")
    first = F.min(F.struct(F.col("key").isNull().alias("none"), F.col("key"), F.col("row")))
    copies = cut(rows_all.groupBy("copy").agg(first.alias("first"), F.first("weight").alias("weight"), F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch"))
                 .withColumn("node", F.xxhash64("copy")), "dart-copies")
    ids = cut(rows_all.select("copy", "key", "row"), "dart-ids")
    drop(rows_all)
    buckets = copies.where("weight > 0").select("node", "weight", F.explode("buckets").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = cut(buckets.join(shared, "bucket"), "dart-shared")
    n_first = n_rows = met.count()
    mates = met.groupBy("node").agg(F.sum("n").alias("mates"))
    buckets = cut(met.drop("n").join(mates, "node"), "dart-buckets", n_rows)
    drop(met)

    wanted = cut(copies.select("node", "first").join(buckets.select("node").distinct(), "node", "left_semi")
                 .select("node", F.col("first.key").alias("key"), F.col("first.row").alias("row")), "dart-wanted", n_rows)
    n_nodes = wanted.count()
    units = cut(_units_of(docs, sized(wanted, n_nodes), key, text, shingle), "dart-units")
    # a row for each text that shares a bucket: what tells pairs apart
    sketch = cut(copies.select("node", F.col("weight").alias("n"), "sketch").join(units.select("node", "marks"), "node"), "dart-node-sketches")
    units = units.select("node", "units")
    texts = cut(copies.select("copy", "node", "first"), "dart-texts")
    drop(wanted, copies)
    least_agreeing = least_agreement(bands * rows, similarity)
    num, den = similarity
    spark = docs.sparkSession
    done = spark.createDataFrame([], "a long, b long")
    labels = spark.createDataFrame([], "node long, label long")
    n_done, n_labels = 0, 0

    def named(table: DataFrame, node: str, label: str) -> DataFrame:
        known = sized(labels.select(F.col("node").alias("_n"), F.col("label").alias("_l")), n_labels)
        return table.join(known, F.col(node) == F.col("_n"), "left").withColumn(label, F.coalesce("_l", node)).drop("_n", "_l")

    def may_agree(x: str, y: str):
        """Whether sketches and marks of the columns named from x and y agree as a similar pair's do."""
        return (_agreeing(f"{x}sketch", f"{y}sketch", bands * rows) >= least_agreeing) & _may_link(similarity, f"{x}marks", f"{y}marks", f"{x}n", f"{y}n")

    def known(node: str, prefix: str) -> DataFrame:
        return sized(sketch.select(F.col("node").alias(node), *[F.col(c).alias(prefix + c) for c in ("n", "sketch", "marks")]), n_nodes, MARK_ROWS)

    def likely(pairs: DataFrame) -> DataFrame:
        """The pairs of nodes x, y that may be similar."""
        return pairs.join(known("x", "x_"), "x").join(known("y", "y_"), "y").where(may_agree("x_", "y_")).select("x", "y")

    def compare(pairs: DataFrame) -> None:
        """Compare the pairs of nodes x, y that are new, and bring the classes up to date."""
        nonlocal done, n_done, labels, n_labels
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        fresh = cut(pairs.join(sized(done, n_done), ["a", "b"], "left_anti"), "dart-fresh")
        n_new = fresh.count()
        if not n_new:
            drop(fresh)
            return
        done, n_done = done.unionByName(fresh), n_done + n_new
        new = cut(_compare(fresh, n_new, units, similarity).where("linked"), "dart-pairs")
        links = named(named(new, "a", "x"), "b", "y")
        links = cut(links.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "dart-links", n_new)
        joined = components(links)  # class to class
        n_joined = joined.count()
        if n_joined:
            to = sized(joined.select(F.col("node").alias("label"), F.col("label").alias("to")), n_joined)
            moved = labels.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
            now = cut(moved.unionByName(joined.join(sized(labels, n_labels), "node", "left_anti")), "dart-labels", n_labels + n_joined)
            drop(labels)
            labels, n_labels = now, now.count()
        drop(new, links, joined)

    def may_match(x: str, y: str):
        return (F.col(x) * den >= F.col(y) * num) & (F.col(y) * den >= F.col(x) * num)

    def still_open(table: DataFrame) -> tuple[DataFrame, int, int]:
        """Rows of buckets with several classes, with label and their bucket's n, pairs and lead; all pairs, most of one bucket."""
        rest = named(table, "node", "label")
        leader = F.max_by(F.struct("node", "weight", "mates"), F.struct("mates", -F.col("weight"), "node"))
        first_of = F.max_by("lead", F.struct("lead.mates", -F.col("lead.weight"), "lead.node"))
        per = (rest.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("c"), leader.alias("lead")).groupBy("bucket")
               .agg(F.sum("c").alias("n"), ((F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))) / 2).alias("pairs"), first_of.alias("lead"))
               .where("pairs > 0"))
        per = cut(per, "dart-mixed", n_rows)
        n_per, left, largest = per.agg(F.count(F.lit(1)), F.sum("pairs"), F.max("pairs")).first()
        rest = cut(rest.join(sized(per, n_per), "bucket"), "dart-open", n_rows)
        drop(per)
        return rest, left or 0, largest or 0

    def stars(rest: DataFrame) -> DataFrame:
        """The rows of ``rest`` that don't lead their bucket, with its leader."""
        return rest.where("node != lead.node").select("node", "weight", "mates", F.col("lead.node").alias("l_node"),
                                                      F.col("lead.weight").alias("l_weight"), F.col("lead.mates").alias("l_mates"))

    for n in range(most_rounds + 1):
        rest, left, largest = still_open(buckets)
        if n == 0 and most_rounds:
            best = (stars(rest).where(may_match("weight", "l_weight")).groupBy("node")
                    .agg(F.max(F.struct("l_mates", "l_node")).alias("best")))
            compare(likely(best.select(F.col("node").alias("x"), F.col("best.l_node").alias("y"))))
            opened = rest
            rest, left, largest = still_open(opened.select("node", "weight", "mates", "bucket"))
            drop(opened)
        drop(buckets)
        if not left:
            drop(rest)
            break
        last = n == most_rounds or (left <= pairs_per_row * n_first and largest <= MOST_PAIRS)
        few = F.lit(True) if last else F.col("pairs") <= pairs_per_row * F.col("n")
        small = rest.where(few).select("bucket", "node", "label", "weight").join(known("node", ""), "node")
        other = small.select(*[F.col(c).alias(f"l_{c}") for c in small.columns])
        pairs = (small.join(other, (F.col("bucket") == F.col("l_bucket")) & (F.col("node") < F.col("l_node")) & (F.col("label") != F.col("l_label"))
                            & may_match("weight", "l_weight") & may_agree("", "l_"))
                 .select(F.col("node").alias("x"), F.col("l_node").alias("y")))
        if last:
            compare(pairs)
            drop(rest)
            break
        star = cut(stars(rest.where(~few)).drop("l_mates").distinct(), "dart-star", n_rows)
        compare(pairs.unionByName(likely(star.where(may_match("weight", "l_weight")).select(F.col("node").alias("x"), F.col("l_node").alias("y")))))
        drop(rest)

        # circles: the nodes compared with one leader; open if two of them are not of one class
        by_class = named(star, "node", "label")
        circles = by_class.groupBy("l_node").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("l_node")
        inner = cut(by_class.join(circles, "l_node", "left_semi"), "dart-circles", n_rows)
        drop(star)
        if inner.isEmpty():
            drop(inner)
            break
        beside = cut(_beside(inner, units), "dart-beside")
        drop(inner)
        inside = beside.drop("extra")
        linked = F.col("both") * (num + den) >= (F.col("weight") + F.col("l_weight")) * num
        partner = inside.where("weight < l_weight").select("l_node", *[F.col(c).alias(f"y_{c}") for c in ("node", "weight", "label", "both")])
        least = (F.col("weight") + F.col("y_weight")) * num
        near = (inside.where(~linked).join(partner, "l_node")
                .where((F.col("node") != F.col("y_node")) & (F.col("label") != F.col("y_label"))
                       & (F.col("both") * (num + den) >= least) & (F.col("y_both") * (num + den) >= least))
                .select(F.col("node").alias("x"), F.col("y_node").alias("y")))
        compare(likely(near))
        again = beside.select("node", "weight", "mates", "label", "l_node", F.explode("extra").alias("unit"))
        again = again.withColumn("bucket", F.xxhash64("l_node", "unit")).drop("l_node", "unit")
        mixed = again.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("bucket")
        buckets = cut(again.drop("label").join(mixed, "bucket", "left_semi"), "dart-buckets")
        drop(beside)
        n_rows = buckets.count()

    grouped = texts.select("node", "first").join(sized(labels, n_labels), "node")
    heads = grouped.groupBy("label").agg(F.min("first").alias("head"))
    grouped = cut(grouped.join(heads, "label").select("node", "head"), "dart-classes", n_labels)
    classes = texts.select("copy", "node", "first").join(sized(grouped, n_labels), "node", "left").select(
        "copy", F.coalesce("head", "first").alias("head"))
    out = cut(ids.join(classes, "copy").select(
        F.col("key").alias(key), "row", F.col("head.key").alias("class_id"), F.col("head.row").alias("class_row")), "dart-result")
    keep(out)
    return out


@scoped
def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that represent their class, with all their columns.

    Of rows equal in ``key`` and ``text`` one stays.
    """
    classes = near_duplicates(docs, key, text, **how)
    apart = ~(F.col(key).eqNullSafe(F.col("class_id")) & (F.col("row") == F.col("class_row")))
    others = cut(classes.where(apart).select(F.col(key).alias("other"), F.col("row").alias("other_row")).distinct(), "dart-others")
    keep(others)
    # the row itself is one column, so that its columns may have any names
    rows = docs.select(F.struct("*").alias("doc"), F.col(key).alias("key"), _row_id(key, text).alias("row"))
    kept = rows.join(sized(others, others.count()), F.col("key").eqNullSafe(F.col("other")) & (F.col("row") == F.col("other_row")), "left_anti")
    repeated = classes.groupBy(key, "row").count().where("count > 1")
    if not repeated.isEmpty():
        rest = [F.col(f"doc.`{c}`") for c in docs.columns if c not in (key, text)]
        one = Window.partitionBy("key", "row").orderBy(*rest or [F.col("key")])
        kept = kept.withColumn("nth", F.row_number().over(one)).where("nth = 1")
    return kept.select("doc.*")
