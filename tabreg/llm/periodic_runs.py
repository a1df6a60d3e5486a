"""Periodic runs of words in a text, by a suffix automaton with link-cut access.

The suffix links of a text's automaton form a tree in which the path from a
prefix's state to the root holds all its suffixes. Prefixes are taken in
order; access to a prefix's state recolours its path with the prefix's end, so
a node's colour is where its word last ended. The old colours of the path come
in segments; a segment of colour e whose deepest node has length m says that
the text up to i and up to e agree in exactly m words. With d = i - e, m >= d
means that a square of period d ends at i, and that d holds from e - m + 1 on.
The last occurrence of a word that has no shorter period is the right one, so
each d is a smallest period, and the ends i of one (start, d) are consecutive:
the last one ends the run.

Paths are cut into heavy ones; each keeps its colours as a stack of segments,
topmost last. Access to a node touches O(log n) heavy paths and removes what
it covers, O(n log n) segments in all.

Only words that can be in a run go through the automaton: with k half of the
least run length, every word of a run lies in a stretch of k words that occurs
twice in the run (for a run of period q and length of 2 q or more, words 0 to
L - q - 1 by stretches that recur q later, words q to L - 1 by those that were
q earlier). So words outside of repeated stretches split the text, which is
done for many texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.llm.textnum import mix, slices

LEAST_RUN = 12
SLICE_CHARS = 2_000_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)


class _Codes(dict):
    """Words as numbers, in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def automaton(seq: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(suffix link, longest length, state of each prefix) of the suffix automaton."""
    step, link, length = [{}], [-1], [0]
    prefix, last = [], 0
    for c in seq:
        cur = len(length)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(length)
                step.append(step[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        prefix.append(cur)
        last = cur
    return link, length, prefix


def _heads(link: list[int], length: list[int]) -> list[int]:
    """The topmost node of each node's heavy path."""
    order = np.argsort(np.array(length), kind="stable").tolist()
    size, heavy = [1] * len(link), [-1] * len(link)
    for v in reversed(order[1:]):
        size[link[v]] += size[v]
    for v in order[1:]:
        p = link[v]
        if heavy[p] < 0 or size[v] > size[heavy[p]]:
            heavy[p] = v
    head = list(range(len(link)))
    for v in order[1:]:
        if heavy[link[v]] == v and link[v]:  # the root, the empty word, is on no path
            head[v] = head[link[v]]
    return head


def runs_of(seq: list[int], least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``seq`` of max(least, 2 period) or more, sorted."""
    link, length, prefix = automaton(seq)
    head = _heads(link, length)
    colours: dict[int, list[tuple[int, int]]] = {}
    ends: dict[tuple[int, int], int] = {}
    for i, v in enumerate(prefix):
        newest = -1  # colour met so far on the way up; a deeper node of it told its length
        while v > 0:
            top, deep = head[v], length[v]
            stack = colours.get(top)
            if stack is None:
                colours[top] = [(deep, i)]
                v = link[top]
                continue
            older, newest_here, m = newest, newest, 0
            while stack and stack[-1][0] <= deep:
                m, e = stack.pop()
                if e > older:
                    newest_here = max(newest_here, e)
                    if i - e <= m:
                        ends[e - m + 1, i - e] = i
            if stack and m < deep:  # the node lies inside a segment that goes on below it
                e = stack[-1][1]
                if e > older:
                    newest_here = max(newest_here, e)
                    if i - e <= deep:
                        ends[e - deep + 1, i - e] = i
            newest = newest_here
            stack.append((deep, i))
            v = link[top]
    return sorted((s, i - s + 1, d) for (s, d), i in ends.items() if i - s + 1 >= max(least, 2 * d))


def stretches(doc: np.ndarray, codes: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(begin, end) of the stretches of words, inside one document each, that can hold runs."""
    k = max(1, least // 2)
    part, at = doc.astype(np.int64), np.arange(len(codes))
    while len(at) >= least:
        n = len(at) - k + 1
        gram = mix(part[:n].view(np.uint64) * _GOLD)
        for j in range(k):
            gram = mix(gram * _GOLD + codes[at[j:j + n]].view(np.uint64))
        whole = part[:n] == part[k - 1:]
        order = np.argsort(gram, kind="stable")
        sorted_gram = gram[order]
        twin = np.zeros(n, bool)
        same = sorted_gram[1:] == sorted_gram[:-1]
        twin[order[1:][same]] = True
        twin[order[:-1][same]] = True
        edge = np.zeros(len(at) + 1, np.int64)
        hit = np.flatnonzero(twin & whole)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + k, -1)
        keep = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
        at_kept, part_kept = at[keep], part[keep]
        new = np.ones(len(keep), bool)
        new[1:] = (at_kept[1:] != at_kept[:-1] + 1) | (part_kept[1:] != part_kept[:-1])
        part_kept = np.cumsum(new) - 1
        long = np.bincount(part_kept, minlength=1)[part_kept] >= least if len(keep) else np.zeros(0, bool)
        at_kept, part_kept = at_kept[long], part_kept[long]
        done = len(at_kept) == len(at)
        at, part = at_kept, part_kept
        if done:
            break
    if len(at) < least:
        return []
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    last = np.r_[first[1:], len(at)] - 1
    return list(zip(at[first].tolist(), (at[last] + 1).tolist()))


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_RUN) -> DataFrame:
    """One row per row of ``docs``: ``key``, n_words, runs, collapsed.

    Words are what lies between ASCII white space. ``runs`` lists start (word
    number from 0), length and period, by start and period, of all stretches
    with a smallest period that are ``least`` words and twice the period or
    longer and that no neighbouring word extends. ``collapsed`` is the text's
    words, joined by a space, without those that some run has after its first
    period. A null, empty or blank text has no words and no runs. Repeated rows
    each get a row, null keys too; an empty table gives no rows; further
    columns are not read. A task holds one document, of any length, and slices
    of documents otherwise.
    """
    kind = docs.schema[key].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type = None

        def seen():
            nonlocal key_type
            for b in batches:
                key_type = b.schema.field(0).type
                yield b
        for part in slices(seen(), SLICE_CHARS, 0, 1):
            code = _Codes()
            words = [t.encode().split() for _, t in part]
            n = np.array([len(w) for w in words], np.int64)
            codes = np.fromiter((code[w] for ws in words for w in ws), np.int64, int(n.sum()))
            begin = np.cumsum(n) - n
            found = [[] for _ in part]
            for lo, hi in stretches(np.repeat(np.arange(len(part)), n), codes, least):
                d = int(np.searchsorted(begin, lo, side="right")) - 1
                while lo >= begin[d] + n[d]:  # documents without words begin at the same place
                    d -= 1
                shift = lo - int(begin[d])
                found[d] += [(s + shift, m, q) for s, m, q in runs_of(codes[lo:hi].tolist(), least)]
            collapsed = []
            for ws, runs in zip(words, found):
                if runs:
                    edge = np.zeros(len(ws) + 1, np.int64)
                    for s, m, q in runs:
                        edge[s + q] += 1
                        edge[s + m] -= 1
                    ws = [ws[j] for j in np.flatnonzero(np.cumsum(edge)[:-1] == 0)]
                collapsed.append(b" ".join(ws).decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in part], key_type), pa.array(n),
                 pa.array([[dict(start=s, length=m, period=q) for s, m, q in runs] for runs in found], run_type),
                 pa.array(collapsed, pa.string())], names=[key, "n_words", "runs", "collapsed"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"`{key}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def _planted(docs: DataFrame) -> DataFrame:
    """doc_id, text: of every tenth document (crc32 of its id), the words from a place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"),
                       F.when(h % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")).alias("w"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("array_join(transform(sequence(0, n - 1), i -> get(w, int(if(i < a, i, a + (i - a) % p)))), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


def _hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def run_report(docs: DataFrame) -> DataFrame:
    """The runs of ``documents``, a tenth of which get a periodic end: counts, the longest run and digests."""
    rows = find_runs(_planted(docs))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                  r["period"].cast("string"), F.lit("\n")))
    return rows.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"), F.expr("(1000 * best.length) div (-best.p)").alias("exponent_milli"),
        _hex(F.array_join(line, "")).alias("runs_sha256"), _hex(F.col("collapsed")).alias("collapsed_sha256"))
