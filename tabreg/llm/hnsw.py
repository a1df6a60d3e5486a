"""Approximate nearest neighbours by hierarchical navigable small-world graphs.

Vectors are dealt to shards by a hash; each shard builds its own graph, held
as flat arrays of neighbours per level, and answers all queries; the shards'
answers are merged. Insertions and searches run for many points at a time with
numpy. Equal vectors are one point of a graph and are expanded afterwards, so
a vector that fills a third of the table is inserted once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.common import cut
from tabreg.llm.textnum import mix, unit

K = 20
LINKS = 16  # neighbours of a point on upper levels; twice as many on the lowest
BUILD_WIDTH = 96
SEARCH_WIDTH = 128
SHARD_ROWS = 16_384
_BATCH = 512


class Hnsw:
    """One graph over the rows of ``points`` for the largest inner product.

    Points get one more coordinate that makes their norms equal, so the
    largest inner product is the smallest distance (queries get zero there).
    """

    def __init__(self, points: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 0):
        norm2 = (points**2).sum(1)
        scale = np.sqrt(norm2.max()) if len(points) else 1.0
        more = np.sqrt(np.maximum(norm2.max(initial=0.0) - norm2, 0))
        self.x = (np.column_stack([points, more]) / scale).astype(np.float32)
        n = len(points)
        draw = 1.0 - unit(mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)))
        self.level = np.minimum((-np.log(draw) / np.log(links)).astype(np.int64), 8)
        self.level[:1] = self.level.max(initial=0)  # the entry point stands on every level
        self.links = links
        top = int(self.level.max(initial=0))
        self.size = [2 * links if lv == 0 else links for lv in range(top + 1)]
        # flat neighbour arrays: row of a point on a level, -1 where free
        self.row = [np.where(self.level >= lv, np.cumsum(self.level >= lv) - 1, -1) for lv in range(top + 1)]
        self.near = [np.full((int((self.level >= lv).sum()), s), -1, np.int32) for lv, s in enumerate(self.size)]
        self.far = [np.full(a.shape, np.inf, np.float32) for a in self.near]
        done = 1
        while done < n:  # the graph of the points so far finds the neighbours of the next
            batch = np.arange(done, min(n, done + max(1, min(_BATCH, done))))
            self._insert(batch, width)
            done = int(batch[-1]) + 1
        for _ in range(5):
            if not self._join_lost():
                break

    def _join_lost(self) -> int:
        """Points that no walk on the lowest level reaches take the last link of a near point that one does."""
        near, n = self.near[0], len(self.x)
        reached = np.zeros(n, bool)
        reached[:1] = True
        edge = np.flatnonzero(reached)
        while len(edge):
            step = near[edge]
            step = np.unique(step[step >= 0])
            edge = step[~reached[step]]
            reached[edge] = True
        lost = np.flatnonzero(~reached)
        for u in lost:
            links = near[u][near[u] >= 0]
            links = links[reached[links]]
            near[links[0] if len(links) else 0, -1] = u
        return len(lost)

    def _distance(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return 1.0 - np.einsum("qd,qcd->qc", q, self.x[ids])

    def _descend(self, q: np.ndarray, entry: np.ndarray, level: int) -> np.ndarray:
        """Greedy walk on one level; entry points for the next."""
        here, best = entry.copy(), self._distance(q, entry[:, None])[:, 0]
        active = np.arange(len(q))
        while len(active):
            near = self.near[level][self.row[level][here[active]]]
            d = np.where(near >= 0, self._distance(q[active], np.maximum(near, 0)), np.inf)
            j = d.argmin(1)
            step = d[np.arange(len(active)), j]
            better = step < best[active]
            active, j, near, step = active[better], j[better], near[better], step[better]
            here[active] = near[np.arange(len(active)), j]
            best[active] = step
        return here

    def _beam(self, q: np.ndarray, entry: np.ndarray, level: int, width: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of ``width`` candidates among points below ``limit``: ids, distances (sorted)."""
        m = len(q)
        ids = np.full((m, width), -1, np.int64)
        dist = np.full((m, width), np.inf, np.float32)
        fresh = np.zeros((m, width), bool)
        ids[:, 0], dist[:, 0], fresh[:, 0] = entry, self._distance(q, entry[:, None])[:, 0], True
        seen = np.zeros((m, limit), bool)
        seen[np.arange(m), entry] = True
        active = np.arange(m)
        row, near_all, size = self.row[level], self.near[level], self.size[level]
        while True:
            j = np.where(fresh[active], dist[active], np.inf).argmin(1)
            go = fresh[active, j]
            active, j = active[go], j[go]
            if not len(active):
                return ids, dist
            fresh[active, j] = False
            near = near_all[row[ids[active, j]]].astype(np.int64)
            ok = near >= 0
            near = np.maximum(near, 0)
            ok &= ~seen[active[:, None], near]
            seen[active[:, None], near] |= ok
            d = np.where(ok, self._distance(q[active], near), np.inf).astype(np.float32)
            all_d = np.concatenate([dist[active], d], 1)
            order = np.argpartition(all_d, width - 1, axis=1)[:, :width]
            take = lambda a: np.take_along_axis(a, order, 1)
            dist[active] = take(all_d)
            ids[active] = take(np.concatenate([ids[active], near], 1))
            fresh[active] = take(np.concatenate([fresh[active], ok], 1))

    def _choose(self, q: np.ndarray, ids: np.ndarray, dist: np.ndarray, keep: int) -> np.ndarray:
        """Of candidates sorted by distance, those nearer to the point than to a chosen one; then the nearest."""
        m, c = ids.shape
        vec = self.x[np.maximum(ids, 0)]
        between = 1.0 - np.einsum("mad,mbd->mab", vec, vec)
        chosen = np.zeros((m, c), bool)
        count = np.zeros(m, np.int64)
        closest = np.full((m, c), np.inf)
        for j in range(c):
            pick = (closest[:, j] > dist[:, j]) & np.isfinite(dist[:, j]) & (count < keep)
            chosen[pick, j] = True
            count[pick] += 1
            closest[pick] = np.minimum(closest[pick], between[pick, j])
        order = np.argsort(np.where(chosen, 0, 1) * 1e6 + np.where(np.isfinite(dist), dist, 1e5), axis=1, kind="stable")[:, :keep]
        good = np.take_along_axis(np.isfinite(dist), order, 1)
        return np.where(good, np.take_along_axis(ids, order, 1), -1)

    def _insert(self, batch: np.ndarray, width: int) -> None:
        limit = int(batch[0])
        q = self.x[batch]
        entry = np.zeros(len(batch), np.int64)
        for lv in range(len(self.near) - 1, -1, -1):
            here = np.flatnonzero(self.level[batch] >= lv)
            above = np.flatnonzero(self.level[batch] < lv)
            entry[above] = self._descend(q[above], entry[above], lv)
            if not len(here):
                continue
            ids, dist = self._beam(q[here], entry[here], lv, width, limit)
            order = np.argsort(dist, axis=1)
            ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
            entry[here] = ids[:, 0]
            # the batch's own points are candidates too, in one matrix product
            peers = 1.0 - q[here] @ q[here].T
            np.fill_diagonal(peers, np.inf)
            few = min(16, len(here) - 1)
            if few > 0:
                j = np.argpartition(peers, few - 1, axis=1)[:, :few]
                ids = np.concatenate([ids, batch[here][j]], 1)
                dist = np.concatenate([dist, np.take_along_axis(peers, j, 1)], 1)
            order = np.argsort(dist, axis=1)[:, :2 * self.links + 16]
            ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
            picked = self._choose(q[here], ids, dist, self.links)
            self._link(lv, np.repeat(batch[here], picked.shape[1]), picked.ravel())

    def _link(self, lv: int, a: np.ndarray, b: np.ndarray) -> None:
        """Add links both ways; a full row keeps a choice of old and new."""
        ok = b >= 0
        a, b = np.concatenate([a[ok], b[ok]]), np.concatenate([b[ok], a[ok]])
        pair = np.unique(a * len(self.x) + b)
        a, b = pair // len(self.x), pair % len(self.x)
        d = (1.0 - np.einsum("nd,nd->n", self.x[a], self.x[b])).astype(np.float32)
        start = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        count = np.diff(np.append(start, len(a)))
        rows, size = self.row[lv][a[start]], self.size[lv]
        nth = np.arange(len(a)) - np.repeat(start, count)
        for lo in range(0, len(start), 2048):  # bounded working arrays
            part = slice(lo, lo + 2048)
            n_part = len(start[part])
            wide = int(count[part].max())
            ids = np.full((n_part, size + wide), -1, np.int64)
            dist = np.full((n_part, size + wide), np.inf, np.float32)
            ids[:, :size], dist[:, :size] = self.near[lv][rows[part]], self.far[lv][rows[part]]
            inside = slice(int(start[part][0]), int(start[part][-1] + count[part][-1]))
            at = np.repeat(np.arange(n_part), count[part])
            ids[at, size + nth[inside]], dist[at, size + nth[inside]] = b[inside], d[inside]
            order = np.argsort(dist, axis=1)
            ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
            dist[:, 1:][(ids[:, 1:] == ids[:, :-1]) & (ids[:, 1:] >= 0)] = np.inf
            over = np.isfinite(dist).sum(1) > size
            order = np.argsort(dist, axis=1)
            ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
            out = np.where(np.isfinite(dist[:, :size]), ids[:, :size], -1)
            if over.any():
                width = min(ids.shape[1], 2 * size)
                who = a[start[part]][over]
                out[over] = self._choose(self.x[who], ids[over][:, :width], dist[over][:, :width], size)
            self.near[lv][rows[part]] = out
            far = 1.0 - np.einsum("nd,ncd->nc", self.x[a[start[part]]], self.x[np.maximum(out, 0)])
            self.far[lv][rows[part]] = np.where(out >= 0, far, np.inf)

    def search(self, queries: np.ndarray, k: int, width: int = SEARCH_WIDTH) -> np.ndarray:
        """(queries, k) row numbers, -1 beyond the last."""
        out = np.full((len(queries), k), -1, np.int64)
        n = len(self.x)
        if not n:
            return out
        width = max(width, k)
        if n <= width:  # so wide a beam holds every point
            found = np.argsort(-(queries @ self.x[:, :-1].T.astype(float)), axis=1, kind="stable")[:, :k]
            out[:, :found.shape[1]] = found
            return out
        step = max(1, min(_BATCH, 32_000_000 // n))  # the seen marks take step * n bytes
        for lo in range(0, len(queries), step):
            q = queries[lo:lo + step]
            q = q / np.maximum(np.sqrt((q**2).sum(1, keepdims=True)), 1e-30)
            q = np.column_stack([q, np.zeros(len(q))]).astype(np.float32)
            entry = np.zeros(len(q), np.int64)
            for lv in range(len(self.near) - 1, 0, -1):
                entry = self._descend(q, entry, lv)
            ids, dist = self._beam(q, entry, 0, width, n)
            order = np.argsort(dist, axis=1)[:, :k]
            ids = np.where(np.isfinite(np.take_along_axis(dist, order, 1)), np.take_along_axis(ids, order, 1), -1)
            out[lo:lo + step, :ids.shape[1]] = ids
        return out


def _valid(rows: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (rows.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
            .where(fine & F.exists("v", lambda x: x != 0)))


def search(rows: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = K,
           shard_rows: int = SHARD_ROWS, links: int = LINKS, build_width: int = BUILD_WIDTH,
           search_width: int = SEARCH_WIDTH) -> DataFrame:
    """The ``k`` rows of largest inner product for every row where ``is_query`` holds.

    ``is_query``: a Column over ``key``. Returns query_id, rank (from 1),
    vec_id, score (inner product in double precision); ties go to the smaller
    key, a row is no answer to itself, and all candidates are returned if
    there are fewer than ``k``. Vectors null, zero or holding null or
    non-finite components take no part, nor do null keys; rows equal in key
    and vector count once; vectors of different length never meet. A shard
    holds about ``shard_rows`` different vectors. An empty table gives no rows.
    """
    spark = rows.sparkSession
    more = k + 1  # members of a class of equal vectors that can be among the answers, the query's own row included
    members = Window.partitionBy("v").orderBy("id")
    # dense_rank keeps its rows in each task before the shuffle, however large a class is
    least = (_valid(rows, key, vector).withColumn("_n", F.dense_rank().over(members)).where(F.col("_n") <= more))
    classes = cut(least.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
                  .select(F.md5(F.to_json(F.struct("v"))).alias("class"), "v", "ids"), "hnsw-classes")
    asked = (_valid(rows, key, vector).where(is_query(F.col("id"))).distinct()
             .select("id", F.md5(F.to_json(F.struct("v"))).alias("class")))
    asked = cut(asked, "hnsw-asked")
    n = classes.count()
    shards = max(1, -(-n // shard_rows))
    shard = F.pmod(F.xxhash64("class"), F.lit(shards)).cast("int")
    points = classes.select(shard.alias("shard"), F.size("v").alias("dim"), "class", "v", "ids", F.lit(False).alias("query"))
    queries = (classes.join(asked.select("class").distinct(), "class", "left_semi")
               .select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.size("v").alias("dim"), "class", "v",
                       F.array().cast("array<bigint>").alias("ids"), F.lit(True).alias("query")))

    def answer(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        dim = key[1].as_py()
        v = group.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        query = group.column("query").to_numpy()
        ids = group.column("ids").to_pylist()
        name = group.column("class").to_numpy()
        order = np.argsort(name, kind="stable")  # the graph doesn't depend on the order of arrival
        order_p, order_q = order[~query[order]], order[query[order]]
        x = v[order_p]
        q = v[order_q]
        hits = Hnsw(x, links, build_width).search(q, more, search_width)
        out = {"class": [], "vec_id": [], "score": []}
        for at in range(len(q)):
            found = hits[at][hits[at] >= 0]
            score = x[found] @ q[at]
            best = sorted((-s, i) for s, f in zip(score.tolist(), found) for i in ids[order_p[f]])[:more]
            out["class"] += [name[order_q[at]]] * len(best)
            out["vec_id"] += [i for _, i in best]
            out["score"] += [-s for s, _ in best]
        return pa.table({"class": pa.array(out["class"], pa.string()), "vec_id": pa.array(out["vec_id"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})

    parts = cut(points.unionByName(queries).groupBy("shard", "dim").applyInArrow(
        answer, "class string, vec_id long, score double"), "hnsw-answers")
    best = Window.partitionBy("class").orderBy(F.col("score").desc(), "vec_id")
    merged = parts.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= more).drop("_n")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (asked.select(F.col("id").alias("query_id"), "class").join(merged, "class").where("vec_id != query_id")
            .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
