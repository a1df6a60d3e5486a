"""Language-model scores from a probabilistic suffix tree over words.

Candidate states are all contexts of one to ``depth`` words (of two or more
words: seen twice or more, as a kept transition is), however likely their own words are.
A transition is kept if its count is far above what the parent state predicts, a state if its kept
transitions make the training text more likely than its parent does (a
divergence test in log10 units). A state gives what it has seen beyond its
kept transitions, and a little more, to its parent's distribution, so every
state is a proper distribution and the root is the smoothed unigram model.

With that, the log probability of a token is a sum of table values: its
unigram, and for each suffix that is a state the weight handed to the parent
and, if kept, the gain of the transition. Model and scores are sums of
looked-up values: the most frequent entries (a bounded number) are broadcast,
a fixed-size bit filter drops keys the table cannot hold, and the rest is
joined. No table is ever whole in one place.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.llm.common import cut, shuffle_partitions
from tabreg.llm.textnum import WordHashes, mix, remembers, slices, working
from tabreg.sources.scratch import drop, keep, scoped

DEPTH = 2
ADD = 0.1  # of the unigram model
OWN = 0.5  # weight a state gives its parent beyond the unkept counts
KEPT_GAIN = 6.0  # log likelihood (nats) a transition must gain over its parent
STATE_GAIN = 1.0  # log10 likelihood a state must gain over its parent
HOT_ENTRIES = 1_000_000
HOT_CONTEXTS = 200_000  # of two or more words, at most, whose transitions are dealt out one by one
#: The filter has 16 bits a key or more, and 2^19 to 2^27 bits.
_LEAST_BITS, _MOST_BITS = 19, 27
_ODD = (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
SLICE_CHARS = 4_000_000
GROUP_TOKENS = 600_000
ASK_PARTS = 4  # of the table, joined one after another, so that a part's keys only are on their way; a power of two
CHOICE_ROWS = 50_000  # transitions whose states are judged together

_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_END = np.uint64(0x5851F42D4C957F2D)
_K = np.uint64(0x9E3779B97F4A7C15)
_WORD, _STATE, _STEP = np.uint64(0x1234567), np.uint64(0x2345671), np.uint64(0x3456712)
REMEMBERED = 20_000  # words
_HASHES = WordHashes(REMEMBERED)
remembers("suffix_tree_lm", _HASHES.clear)


def _hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of distinct words; among many, most are rare, and looking them up costs more than hashing them."""
    if len(words) <= REMEMBERED:
        return _HASHES.array(words)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _worded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document index and position of all tokens, hashes of the distinct words, each token's place among them)."""
    working("suffix_tree_lm")
    data = [t.encode().translate(_LOWER) + b" " for t in texts]
    chars = np.frombuffer(b"".join(data), np.uint8)
    space = _SPACE[chars]
    edges = np.flatnonzero(np.diff(~space, prepend=False))  # starts and ends of words in turn; the last is a space
    sizes = np.diff(edges)[::2]
    words = pa.Array.from_buffers(pa.large_binary(), len(sizes), [
        None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)), pa.py_buffer(chars[~space])]).dictionary_encode()
    vocabulary = np.append(_hashes(words.dictionary.to_numpy(zero_copy_only=False)), _END)
    ends = np.searchsorted(edges[::2], np.cumsum([len(x) for x in data], dtype=np.int64))
    n = np.diff(ends, prepend=0) + 1
    last = np.cumsum(n) - 1
    word = np.full(int(n.sum()), len(vocabulary) - 1, np.int32)
    inner = np.ones(len(word), bool)
    inner[last] = False
    word[inner] = words.indices.to_numpy()
    return np.repeat(np.arange(len(texts)), n), np.arange(len(word)) - np.repeat(last + 1 - n, n), vocabulary, word


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document index, position, word hash) of all tokens; every text ends with one end token.

    A-Z are lower-cased; words are runs without ASCII white space.
    """
    doc, pos, vocabulary, word = _worded(texts)
    return doc, pos, vocabulary[word]


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts ``x``, where each distinct value starts in it)."""
    order = np.argsort(x)
    x = x[order]
    return order, np.flatnonzero(np.concatenate([[len(x) > 0], x[1:] != x[:-1]])[:len(x)])


def states(pos: np.ndarray, w: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For d = 1 .. depth: (token indices with d words before them, state key, transition key).

    The transition key of d words is the state key of d + 1 for the next token.
    """
    out = []
    prev = np.roll(mix(w * _K + np.uint64(1)), 1)
    for d in range(1, depth + 1):
        step = mix(prev * _K + w)
        at = np.flatnonzero(pos >= d)
        out.append((at, prev[at], step[at]))
        prev = np.roll(step, 1)
    return out


def _state(words: list[np.ndarray]) -> np.ndarray:
    """State key of some words, oldest first."""
    key = mix(words[0] * _K + np.uint64(1))
    for w in words[1:]:
        key = mix(key * _K + w)
    return key


class _Places:
    """Finds the place of evenly spread 64-bit keys in a list, many at a time (open addressing)."""

    def __init__(self, keys: np.ndarray):
        size = 1 << max(4, (2 * len(keys)).bit_length())
        self.mask = np.uint64(size - 1)
        self.slot = np.full(size, -1, np.int32)
        self.key = np.zeros(size, np.uint64)
        at, todo = (keys & self.mask).astype(np.int64), np.arange(len(keys), dtype=np.int32)
        while len(todo):
            free = self.slot[at] < 0
            self.slot[at[free]] = todo[free]
            won = self.slot[at] == todo
            self.key[at[won]] = keys[todo[won]]
            at, todo = (at[~won] + 1) & int(self.mask), todo[~won]
        self.keys = keys

    def __reduce__(self):
        return _Places, (self.keys,)  # a third of the slots' size in a broadcast's files

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place, or -1."""
        out = np.full(len(keys), -1, np.int32)
        at, left = (keys & self.mask).astype(np.int64), np.arange(len(keys))
        while len(left):
            same = self.key[at] == keys[left]
            slot = self.slot[at]
            out[left[same]] = slot[same]
            go = ~same & (slot >= 0)
            at, left = (at[go] + 1) & int(self.mask), left[go]
        return out


class _Codes:
    """Words as small numbers: the place of a frequent word in a list; others (code 2^32 - 1) are written out."""

    def __init__(self, words: np.ndarray):
        self.words, self.places = words, _Places(words)

    def codes(self, words: np.ndarray) -> np.ndarray:
        return self.places.find(words).astype(np.uint32)  # -1 becomes 2^32 - 1

    def read(self, codes: np.ndarray, others: np.ndarray) -> np.ndarray:
        rare = codes == np.uint32(0xFFFFFFFF)
        out = np.zeros(len(codes), np.uint64)
        out[~rare] = self.words[codes[~rare]]
        out[rare] = others
        return out


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


class _Lookup:
    """Values of the table's hot entries, and a filter of the keys of all entries."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: np.ndarray, probes: int = 1):
        self.places, self.values, self.bits, self.probes = _Places(keys), values, bits, probes
        self.shift = np.uint64(64 - (len(bits) * 8 - 1).bit_length())

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.zeros(len(keys), bool), np.arange(len(keys))
        for probe in range(self.probes):
            slot = _slot(keys[left], probe, self.shift)
            left = left[(self.bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1]
        out[left] = True
        return out

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(value or 0, is a hot entry, may be another entry)."""
        value, hit = np.zeros(len(keys)), np.zeros(len(keys), bool)
        more = self.maybe(keys)
        at = np.flatnonzero(more)
        place = self.places.find(keys[at])
        at, place = at[place >= 0], place[place >= 0]
        value[at], hit[at], more[at] = self.values[place], True, False
        return value, hit, more


def _slot(keys: np.ndarray, probe: int, shift: np.uint64) -> np.ndarray:
    """The bit of each key for a probe: the upper bits of the key, or of its product with an odd number."""
    return keys * np.uint64(_ODD[probe]) >> shift


def _filter_of(keys: DataFrame) -> tuple[np.ndarray, int]:
    """A bit array, a power of two long, with the bits of every key (long) set, and the number of bits a key has.

    A key has as many bits as let the fewest other keys through, four at most.
    Built in pieces by range; only the array, of bounded size, reaches the driver.
    """
    n = keys.count()
    width = min(_MOST_BITS, max(_LEAST_BITS, (16 * n).bit_length()))
    probes = max(1, min(len(_ODD), int(0.69 * 2**width / max(1, n))))
    shift, size = np.uint64(64 - width), 1 << (_LEAST_BITS - 3)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << (width - 3), np.uint8)
        for b in batches:
            own = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for probe in range(probes):
                slot = _slot(own, probe, shift)
                np.bitwise_or.at(seen, (slot >> np.uint64(3)).astype(np.int64),
                                 np.left_shift(np.uint8(1), (slot & np.uint64(7)).astype(np.uint8)))
        used = [c for c in range(len(seen) // size) if seen[c * size:(c + 1) * size].any()]
        squeeze = zstandard.ZstdCompressor(level=1).compress
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([squeeze(seen[c * size:(c + 1) * size].tobytes()) for c in used], pa.binary())],
            names=["chunk", "bits"])

    def union(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        seen = np.zeros(size, np.uint8)
        for b in group.column("bits"):
            seen |= np.frombuffer(zstandard.ZstdDecompressor().decompress(b.as_py()), np.uint8)
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([seen.tobytes()], pa.binary())})

    out = np.zeros(1 << (width - 3), np.uint8)
    for row in (keys.mapInArrow(bits, "chunk int, bits binary").groupBy("chunk")
                .applyInArrow(union, "chunk int, bits binary").toLocalIterator()):
        out[row["chunk"] * size:(row["chunk"] + 1) * size] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out, probes


def _most_frequent(table: DataFrame, n: str, most: int):
    """(level column, least): rows whose level reaches least are at most ``most`` in number."""
    level = F.floor(F.log2(F.greatest(n, F.lit(1))) * 8)
    sizes = sorted(((r["level"], r["count"]) for r in table.groupBy(level.alias("level")).count().collect()), reverse=True)
    least, total = 10**9, 0  # at most 8 * 63 levels
    for lv, count in sizes:
        total += count
        if total > most:
            break
        least = lv
    return level, least


def _codes_of(counts: DataFrame, most: int):
    level, least = _most_frequent(counts, "c", most)
    words = counts.where(level >= least).select("word").toArrow().column("word").to_numpy().view(np.uint64)
    return counts.sparkSession.sparkContext.broadcast(_Codes(words))


def _lookup_of(table: DataFrame, hot_entries: int):
    """Broadcast the ``hot_entries`` most frequent entries at most, and a filter of the others."""
    level, least = _most_frequent(table, "n", hot_entries)
    hot = table.where(level >= least).select("key", "value").toArrow()
    return table.sparkSession.sparkContext.broadcast(_Lookup(
        hot.column("key").to_numpy().view(np.uint64), hot.column("value").to_numpy(), *_filter_of(table.select("key"))))


def _prepared(docs: DataFrame, key: str, text: str) -> DataFrame:
    held = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 10 == 0
    return docs.select(held.alias("held"), F.col(key).alias("key"), F.col(text).alias("text"))


def _word_counts(rows: DataFrame) -> DataFrame:
    """word (hash as long), c: counts over the training texts."""
    def run(batches):
        held_keys, held_counts, size = [], [], 0

        def out():
            w, at = np.unique(np.concatenate(held_keys), return_inverse=True)
            c = np.bincount(at, np.concatenate(held_counts)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(_signed(w)), pa.array(c)], names=["word", "c"])
        for part in slices(batches, SLICE_CHARS, 0, 1):
            _, _, vocabulary, word = _worded([p[1] for p in part])
            held_keys.append(vocabulary)
            held_counts.append(np.bincount(word, minlength=len(vocabulary)))
            size += len(vocabulary)
            if size > GROUP_TOKENS:
                yield out()
                held_keys, held_counts, size = [], [], 0
        if held_keys:
            yield out()

    return (rows.where("not held").select("key", "text").mapInArrow(run, "word long, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


def _steps(rows: DataFrame, d: int, groups: int, parents, codes) -> DataFrame:
    """group, blob: counted runs of ``d`` words and the next, of the training texts.

    Groups are ranges of a hash. ``parents``: the most frequent runs of ``d`` words, and a filter
    of all seen twice or more. What follows a run is in one group, so that it counts the run as well;
    but what follows a most frequent one, or a single word (``parents`` is None), is dealt out
    by a hash of run and next word, so that no frequent word gathers in one.
    """
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches, SLICE_CHARS, 0, 1):
            _, pos, vocabulary, word = _worded([p[1] for p in part])
            at, state, step = states(pos, vocabulary[word], d)[-1]
            place = step
            if parents is not None:
                _, hot, more = parents.value.find(state)
                use = hot | more
                at, step, place = at[use], step[use], np.where(hot, step, state)[use]
            if not len(at):
                continue
            order, starts = _runs(step)
            first, n = order[starts], np.diff(starts, append=len(order)).astype(np.uint32)
            at, group = at[first], (place[first] >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)
            code = codes.value.codes(vocabulary)
            words = [word[at - j] for j in range(d, -1, -1)]  # oldest first
            coded = [code[w] for w in words]
            order = np.argsort(coded[0].astype(np.uint64) << np.uint64(32) | coded[1])
            order = order[np.argsort(group[order].astype(np.uint16 if groups < 2**16 else np.uint64), kind="stable")]
            n, coded, words = n[order], [c[order] for c in coded], [w[order] for w in words]
            ends = np.searchsorted(group[order], np.arange(groups), side="right")
            ids, blobs, lo = [], [], 0
            for g, hi in enumerate(ends):
                if hi > lo:
                    parts = [n[lo:hi]]
                    for w, c in zip(words, coded):
                        parts += [c[lo:hi], vocabulary[w[lo:hi][c[lo:hi] == np.uint32(0xFFFFFFFF)]]]
                    parts[1] = np.diff(parts[1], prepend=np.uint32(0))
                    ids.append(g)
                    blobs.append(pack(np.array([hi - lo, *map(len, parts[2::2])], np.uint64).tobytes() + b"".join(x.tobytes() for x in parts)))
                lo = hi
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], names=["group", "blob"])

    return rows.where("not held").select("key", "text").mapInArrow(run, "group int, blob binary")


def _frequent(steps: DataFrame, d: int, lookup, parents, codes, p0: float, last: bool) -> DataFrame:
    """Transitions counted twice or more, with what the lookup tells of their parents.

    Those that are surely no more than chance are dropped at the last depth; before, only
    their step and n are given, for they are contexts of the next depth all the same.
    state, step, n, log_p (of the word in the parent state, as far
    as looked up), seen (count of the state, as far as known),
    open (table keys still to be looked up), open_before (that of the word before, depth 1 only), chance.
    """
    schema = "state long, step long, n long, log_p double, seen double, open array<long>, open_before long, chance boolean"

    def merged(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        parts = []
        for blob in group.column("blob"):
            raw = unpack(blob.as_py())
            m, *rare = np.frombuffer(raw, np.uint64, d + 2).astype(int).tolist()
            at = 8 * (d + 2)
            fields = [np.frombuffer(raw, np.uint32, m, at)]
            at += 4 * m
            for i in range(d + 1):
                coded = np.frombuffer(raw, np.uint32, m, at)
                coded = np.cumsum(coded, dtype=np.uint32) if i == 0 else coded
                fields.append(codes.value.read(coded, np.frombuffer(raw[at + 4 * m:at + 4 * m + 8 * rare[i]], np.uint64)))
                at += 4 * m + 8 * rare[i]
            parts.append(fields)
        n, *words = [np.concatenate(c) for c in zip(*parts)]
        del parts, fields
        state = _state(words[:-1])
        step = mix(state * _K + words[-1])
        order, starts = _runs(step)
        first, count = order[starts], np.add.reduceat(n[order], starts, dtype=np.int64)
        use = count >= 2
        kept = first[use]
        state, step, seen = state[first], step[kept], np.zeros(len(kept))
        if d > 1:
            order, starts = _runs(state)
            total = np.empty(len(state))
            total[order] = np.repeat(np.add.reduceat(count[order], starts), np.diff(starts, append=len(order)))
            value, hot, _ = parents.value.find(state[use])
            seen = np.where(hot, value, total[use])
        state, count = state[use], count[use]
        *earlier, w = [c[kept] for c in words]
        look, none = lookup.value, np.uint64(0)
        keys = [mix(w ^ _WORD)]
        for j in range(1, d):
            k = _state(earlier[-j:])
            keys += [mix(k ^ _STATE), mix(mix(k * _K + w) ^ _STEP)]
        log_p, unknown, before = np.full(len(w), p0), [], np.zeros(len(w), np.uint64)
        for k in keys:
            value, _, more = look.find(k)
            log_p += value
            unknown.append(np.where(more, k, none))
        if d == 1:
            k = mix(earlier[0] ^ _WORD)
            value, _, more = look.find(k)
            seen, before = np.round(ADD * 10.0**value - ADD), np.where(more, k, none)
        unknown = np.stack(unknown, 1)
        sure = (before == 0) & (unknown == 0).all(axis=1)
        chance = sure & (_gain(count, seen * 10.0**log_p) < KEPT_GAIN)
        if last:
            state, step, count, log_p, seen, before, unknown = [x[~chance] for x in (state, step, count, log_p, seen, before, unknown)]
            chance = chance[~chance]
        state, log_p, seen = [np.where(chance, x.dtype.type(0), x) for x in (state, log_p, seen)]
        ends = np.cumsum((unknown != 0).sum(axis=1))
        return pa.table([
            pa.array(_signed(state)), pa.array(_signed(step)), pa.array(count), pa.array(log_p), pa.array(seen),
            pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(_signed(unknown[unknown != 0]))),
            pa.array(_signed(before)), pa.array(chance)],
            names=["state", "step", "n", "log_p", "seen", "open", "open_before", "chance"])

    return steps.groupBy("group").applyInArrow(merged, schema)


def _gain(n, expected):
    """Log likelihood (nats) of a Poisson count over its expectation; rising part only."""
    return np.where(n > expected, n * np.log(np.maximum(n, 1) / np.maximum(expected, 1e-300)) - (n - expected), 0.0)


def _chosen(found: DataFrame, table: DataFrame) -> DataFrame:
    """key, value, n, word: the entries of the transitions and states that are kept.

    What the table has for the keys still open comes as further rows of a transition, to be added up.
    A group holds whole states, never all that follows a word, but what ``_frequent`` has left of it.
    """
    open_keys = F.transform("open", lambda k: F.struct(k.alias("key"), F.lit(False).alias("before")))
    of_before = F.array(F.struct(F.col("open_before").alias("key"), F.lit(True).alias("before")))
    asked = (found.where("size(open) > 0 OR open_before != 0")
             .select("state", "step", F.explode(F.concat(open_keys, of_before)).alias("_a")).select("state", "step", "_a.*").where("key != 0"))
    told = asked.join(table.select("key", "value"), "key").select(
        "state", "step", F.lit(0).cast("long").alias("n"), F.when(F.col("before"), 0.0).otherwise(F.col("value")).alias("log_p"),
        F.when(F.col("before"), F.round(F.pow(F.lit(10.0), "value") * ADD - ADD)).otherwise(0.0).alias("seen"))
    rows = found.select("state", "step", "n", "log_p", "seen").unionByName(told)
    groups = max(2 * shuffle_partitions(found.sparkSession), -(-found.count() // CHOICE_ROWS))

    def judged(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        state, step = [group.column(c).to_numpy().view(np.uint64) for c in ("state", "step")]
        order, starts = _runs(step)
        state, step = state[order][starts], step[order][starts]
        n, log_p, seen = [np.add.reduceat(group.column(c).to_numpy()[order], starts) for c in ("n", "log_p", "seen")]
        keep = _gain(n, seen * 10.0**log_p) >= KEPT_GAIN
        state, step, n, log_p, seen = [x[keep] for x in (state, step, n, log_p, seen)]
        order, starts = _runs(state)
        step, n, log_p, seen = [x[order] for x in (step, n, log_p, seen)]
        if len(starts):
            size = np.diff(starts, append=len(order))
            state, seen = state[order][starts], seen[starts]
            rest = seen - np.add.reduceat(n, starts) + OWN
            hand_on = np.log10(rest / (seen + OWN))
            value = np.log10(1 + n / (np.repeat(rest, size) * 10.0**log_p))
            good = np.add.reduceat(n * value, starts) + seen * hand_on >= STATE_GAIN
            told = np.repeat(good, size)
            key = np.concatenate([mix(state[good] ^ _STATE), mix(step[told] ^ _STEP)])
            value, n = np.concatenate([hand_on[good], value[told]]), np.concatenate([seen[good].astype(np.int64), n[told]])
        else:
            key, value, n = step, log_p, n
        return pa.table([pa.array(_signed(key)), pa.array(value), pa.array(n), pa.array(np.zeros(len(key), bool))],
                        names=["key", "value", "n", "word"])

    return (rows.withColumn("group", F.pmod("state", F.lit(groups)).cast("int")).groupBy("group")
            .applyInArrow(judged, "key long, value double, n long, word boolean"))


@scoped
def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH,
        hot_entries: int = HOT_ENTRIES):
    """Learn from the training rows (crc32 of the key's text mod 10 is not 0).

    Returns (table, lookup, facts): the model as rows key, value, n, word;
    the broadcast lookup; and {train_tokens, distinct, unseen} with the log10
    probability of a word never seen. No training rows: an empty model.
    """
    model, parts = _fit(docs, key, text, depth, hot_entries)
    keep(*parts)
    return model


def _fit(docs: DataFrame, key: str, text: str, depth: int, hot_entries: int):
    """The model of ``fit`` and the written tables that it reads."""
    rows = _prepared(docs, key, text)
    counts = cut(_word_counts(rows), "pst-words")
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_all, v = int(total["n"] or 0), int(total["v"])
    p0 = float(np.log10(ADD / (n_all + ADD * (v + 1))))

    def hashed(words: DataFrame) -> DataFrame:
        def run(batches):
            for b in batches:
                k = mix(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) ^ _WORD)
                yield pa.RecordBatch.from_arrays([pa.array(_signed(k)), b.column(1)], names=["key", "n"])
        return words.mapInArrow(run, "key long, n long")

    value = F.log10((F.col("n") + ADD) / ADD)
    table = cut(hashed(counts).select("key", value.alias("value"), "n", F.lit(True).alias("word")), "pst-unigrams")
    parts = [table]
    lookup = _lookup_of(table, hot_entries)
    codes = _codes_of(counts, hot_entries)
    drop(counts)
    groups = max(1, -(-n_all // GROUP_TOKENS))
    parents = None
    for d in range(1, depth + 1):
        counted = cut(_frequent(_steps(rows, d, groups, parents, codes), d, lookup, parents, codes, p0, d == depth), "pst-frequent")
        lookup.destroy()  # all that used these is written
        if parents is not None:
            parents.destroy()
        if d == depth:
            codes.destroy()
        entries = cut(_chosen(counted.where("not chance"), table), "pst-table")
        parts.append(entries)
        table = table.unionByName(entries)
        if d < depth:
            parents = _lookup_of(counted.select(F.col("step").alias("key"), F.col("n").cast("double").alias("value"), "n"),
                                 min(hot_entries, HOT_CONTEXTS))
        drop(counted)
        lookup = _lookup_of(table, hot_entries)
    return (table, lookup, {"train_tokens": n_all, "distinct": v, "unseen": p0}), parts


def score(docs: DataFrame, model, key: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """One row per row of ``docs``: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    table, lookup, facts = model
    p0 = facts["unseen"]
    rows = _prepared(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()

    asked_names = [f"{c}{p}" for p in range(ASK_PARTS) for c in ("open", "times")]
    part_shift = np.uint64(65 - ASK_PARTS.bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 36, 0
        look, key_type = lookup.value, None

        def seen():
            nonlocal key_type
            for b in batches:
                key_type = b.schema.field(1).type
                yield b
        for part in slices(seen(), SLICE_CHARS // 2, 0, 1, 2):
            doc, pos, vocabulary, word = _worded([p[2] for p in part])
            m = len(part)
            size = np.bincount(doc, minlength=m)
            k = mix(vocabulary ^ _WORD)
            value, hit, more = [x[word] for x in look.find(k)]
            base = np.bincount(doc, value, m) + size * p0
            known = np.bincount(doc, hit, m)
            open_doc, open_key = [doc[more]], [k[word[more]]]
            gain = np.zeros(m)
            for d, (at, state, step) in enumerate(states(pos, vocabulary[word], depth), 1):
                at_doc = doc[at]
                if d == 1:  # the state is a word
                    k, of = mix(_state([vocabulary]) ^ _STATE), word[at - 1]
                    value, hit, more = [x[of] for x in look.find(k)]
                    open_key.append(k[of[more]])
                else:
                    k = mix(state ^ _STATE)
                    value, hit, more = look.find(k)
                    open_key.append(k[more])
                open_doc.append(at_doc[more])
                gain += np.bincount(at_doc, value, m)
                there = hit | more  # only a state has transitions
                k, at_doc = mix(step[there] ^ _STEP), at_doc[there]
                value, _, more = look.find(k)
                gain += np.bincount(at_doc, value, m)
                open_doc.append(at_doc[more])
                open_key.append(k[more])
            open_doc, open_key = np.concatenate(open_doc), np.concatenate(open_key)
            order = np.argsort(open_key)
            order = order[np.argsort(open_doc[order].astype(np.uint16), kind="stable")]  # a slice has 20 000 rows at most
            open_doc, open_key = open_doc[order], open_key[order]
            first = np.ones(len(order), bool)  # a key is asked for once a row
            first[1:] = (open_doc[1:] != open_doc[:-1]) | (open_key[1:] != open_key[:-1])
            first = np.flatnonzero(first)
            times = np.diff(first, append=len(order)).astype(np.int32)
            open_doc, open_key, lists = open_doc[first], open_key[first], []
            for p in range(ASK_PARTS):
                own = open_key >> part_shift == p
                ends = pa.array(np.searchsorted(open_doc[own], np.arange(m + 1)).astype(np.int32))
                lists += [pa.ListArray.from_arrays(ends, pa.array(_signed(open_key[own]))), pa.ListArray.from_arrays(ends, pa.array(times[own]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(task + made + np.arange(m)), pa.array([p[1] for p in part], key_type),
                 pa.array([p[0] for p in part], pa.bool_()), pa.array(size), pa.array(known.astype(np.int64)),
                 pa.array(base), pa.array(gain), *lists],
                names=["row", "key", "held", "size", "known", "base", "gain", *asked_names])
            made += m

    lists = ", ".join(f"open{p} array<long>, times{p} array<int>" for p in range(ASK_PARTS))
    found = cut(rows.mapInArrow(run, f"row long, key {kind}, held boolean, size long, known long, base double, gain double, {lists}"), "pst-asked")
    word, told = F.col("word").cast("int"), []
    for p in range(ASK_PARTS):
        asked = found.select("row", F.explode(F.arrays_zip(f"open{p}", f"times{p}")).alias("_a")).select(
            "row", F.col(f"_a.open{p}").alias("key"), F.col(f"_a.times{p}").alias("times"))
        part = table.where(F.shiftrightunsigned("key", int(part_shift)) == p).select("key", "value", "word")
        told.append(cut(asked.join(part, "key").groupBy("row").agg(
            F.sum(F.col("times") * word).alias("m_known"), F.sum(F.col("times") * F.col("value") * word).alias("m_base"),
            F.sum(F.col("times") * F.col("value") * (1 - word)).alias("m_gain")), "pst-told"))
    sums = [F.sum(c).alias(c) for c in ("m_known", "m_base", "m_gain")]
    more = functools.reduce(DataFrame.unionByName, told).groupBy("row").agg(*sums)
    out = found.drop(*asked_names).join(more, "row", "left").na.fill(0, ["m_known", "m_base", "m_gain"])
    base = F.col("base") + F.col("m_base")
    out = cut(out.select(F.col("key").alias(key), F.col("held").alias("held_out"), F.col("size").alias("n_tokens"),
                         (F.col("known") + F.col("m_known")).cast("long").alias("n_known"),
                         F.lit(facts["train_tokens"]).cast("long").alias("train_tokens"), base.alias("base_score"),
                         (base + F.col("gain") + F.col("m_gain")).alias("score")), "pst-scores")
    drop(found, *told)
    keep(out)
    return out


@scoped
def fit_and_score(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH,
                  hot_entries: int = HOT_ENTRIES) -> DataFrame:
    """Fit on the training rows and score every row of ``docs``.

    A null text is empty and has the end token only. A null key is held out.
    Repeated rows are learnt and scored each. Without training rows every
    token is unseen. An empty table gives no rows; further columns are not read.
    """
    model, parts = _fit(docs, key, text, depth, hot_entries)
    keep(*parts)
    return score(docs, model, key, text, depth)
