import math

import numpy as np
import pytest

from tabreg.llm import hnsw


def brute(rows, asked, k):
    """{query: [(vec_id, score)]}: largest inner product, ties to the smaller id."""
    fine = [(i, tuple(v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    fine = sorted(set(fine))
    out = {}
    for i, v in fine:
        if asked(i):
            found = [(sum(a * b for a, b in zip(v, w)), j) for j, w in fine if j != i and len(w) == len(v)]
            out[i] = [(j, s) for s, j in sorted(found, key=lambda x: (-x[0], x[1]))[:k]]
    return out


def got_of(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("shape", ["unit", "lengths", "clusters"])
def test_recall_of_one_graph(shape):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 24))
    if shape == "clusters":
        x = x[rng.integers(0, 30, 3000)] + 0.2 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if shape == "lengths":
        x *= rng.uniform(0.5, 2.0, (3000, 1))
    graph = hnsw.Hnsw(x)
    found = graph.search(x[:200], 20, hnsw.SEARCH_WIDTH)
    best = np.argsort(-(x[:200] @ x.T), axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(found, best)]) >= 0.95
    assert graph._join_lost() == 0  # every point is reached
    for level, near in enumerate(graph.near):  # flat arrays of the promised width, links to points of the level
        assert near.shape[1] == (2 if level == 0 else 1) * hnsw.LINKS
        assert (graph.level[near[near >= 0]] >= level).all()


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]  # copies: ties go to the smaller id
    rows += [(300, None), (301, [0.0] * 6), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6),
             (304, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (305, [1.0, 2.0]), (306, [2.0, 1.0]), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = got_of(hnsw.search(df, lambda i: i % 5 == 0, shard_rows=40))
    want = brute(rows, lambda i: i % 5 == 0, 20)
    assert set(got) <= set(want) and all(len(want[q]) == 0 for q in set(want) - set(got))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in got)
    assert hits == sum(len(w) for w in want.values())
    for q, found in got.items():
        assert len(found) == len(want[q])
        true = dict(brute(rows, lambda i: i == q, 10**6)[q])
        assert all(s == pytest.approx(true[i], abs=1e-12) for i, s in found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_table_recall_and_empty(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = got_of(hnsw.search(df, lambda i: i % 20 == 0, shard_rows=200))
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], lambda i: i % 20 == 0, 20)
    recall = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want]
    assert sum(recall) / len(recall) >= 0.95
    assert hnsw.search(df.where("false"), lambda i: i % 20 == 0).count() == 0
