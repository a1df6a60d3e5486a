import random
from collections import Counter

import numpy as np
import pytest

from tabreg.llm import dartminhash as dm
from tabreg.llm.components import components


def weights(text):
    w = (text or "").lower().split()
    return Counter([tuple(w[i:i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else []))


def brute(rows):
    """{key: (class id, links to other texts)} by comparing all pairs."""
    texts = [(k, weights(t), " ".join((t or "").lower().split())) for k, t in rows]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, (_, a, s) in enumerate(texts):
        for j in range(i):
            b = texts[j][1]
            if s == texts[j][2] or 5 * sum((a & b).values()) >= 4 * sum((a | b).values()) > 0:
                parent[root(i)] = root(j)
    first = {}
    for i, (k, _, _) in enumerate(texts):
        if k is not None:
            first[root(i)] = min(first.get(root(i), k), k)
    return [(k, first.get(root(i))) for i, (k, _, _) in enumerate(texts)]


def got_of(df):
    return [(r.doc_id, r.class_id) for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


def test_documents_equal_brute_force(spark, sf_docs):
    got = dm.near_duplicates(sf_docs)
    assert order(got_of(got)) == order(brute([(r.doc_id, r.text) for r in sf_docs.collect()]))


def variants(rnd, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = f"n{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_groups_on_both_sides_of_the_threshold(spark, rounds):
    rnd = random.Random(11)
    base = [f"b{i}" for i in range(160)]
    # copies at the threshold of their base, but not of each other, with copies of copies among them
    texts = [" ".join(base)] + variants(rnd, base, 40, 5) + variants(rnd, [f"c{i}" for i in range(90)], 10, 2)
    texts += [" ".join(f"x{rnd.randrange(500)}" for _ in range(60)) for _ in range(20)]
    texts += variants(rnd, texts[3].split(), 6, 2) + variants(rnd, texts[9].split()[:150], 6, 2)
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, texts[0]), (901, texts[0].upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dm.near_duplicates(docs, most_rounds=rounds, pairs_per_row=0)
    assert order(got_of(got)) == order(brute(rows))


def test_signature_estimates_weighted_similarity():
    rnd = random.Random(4)
    base = [f"b{i}" for i in range(300)]
    line = " l1 l2 l3 l4 l5 l6" * 20
    texts = [" ".join(base), " ".join(base[:240]) + line, " ".join(base[:280]) + line, "a b", "a b", "c"]
    texts += variants(rnd, base, 20, 30)
    doc, units = dm.elements(texts)
    sig = dm.signatures(doc, units, len(texts), 1024)
    assert (sig[:4] != 0).all() and (sig[3] == sig[4]).all() and not (sig[3] == sig[5]).any()
    for i in range(len(texts)):
        a, b = weights(texts[0]), weights(texts[i])
        true = sum((a & b).values()) / sum((a | b).values())
        assert abs((sig[0] == sig[i]).mean() - true) < 0.07
    a, b = weights(texts[1]), weights(texts[2])
    assert abs((sig[1] == sig[2]).mean() - sum((a & b).values()) / sum((a | b).values())) < 0.07


def test_empty_texts_and_batches_do_not_matter():
    doc, units = dm.elements(["", "a b c d e f", "  "])
    assert doc.tolist() == [1, 1]
    assert not dm.signatures(doc, units, 3, 16)[0].any()
    alone = dm.elements(["a b c d e f"])
    assert (dm.signatures(*alone, 1, 16)[0] == dm.signatures(doc, units, 3, 16)[1]).all()


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = dm.near_duplicates(odd_docs)
    assert order(got_of(got)) == order(brute(rows))
    assert dm.near_duplicates(odd_docs.where("false")).count() == 0
    kept = dm.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 6, 7, 8]
    assert dm.drop_near_duplicates(odd_docs.where("doc_id is null").unionByName(odd_docs.where("doc_id is null"))).count() == 1


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (100, 100)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[101] == 100
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bands_find_pairs_at_the_threshold():
    s, miss = 0.8, (1 - 0.8**dm.ROWS) ** dm.BANDS
    assert miss < 1e-4 and np.isclose(s, dm.SIMILARITY[0] / dm.SIMILARITY[1])


def test_sketches_fail_pairs_at_the_threshold_as_seldom_as_stated(spark):
    k = dm.BANDS * dm.ROWS
    rng = np.random.default_rng(5)
    sig = rng.integers(0, 2**63, (40, k)).astype(np.uint64)
    same = rng.random((40, k)) < np.linspace(0, 1, 40)[:, None]
    other = np.where(same, sig, rng.integers(0, 2**63, (40, k)).astype(np.uint64))
    rows = spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(dm.sketches(sig), dm.sketches(other)))],
                                 "i int, a array<long>, b array<long>")
    got = {r.i: r.n for r in rows.select("i", dm._agreeing("a", "b", k).alias("n")).collect()}
    low = [dm.salted(s, 11) & np.uint64(2**dm.SKETCH_BITS - 1) for s in (sig, other)]
    assert [got[i] for i in range(40)] == (low[0] == low[1]).sum(axis=1).tolist()
    # a similar pair fails with at most the stated probability; the bound is the best one
    least = dm.least_agreement(k, dm.SIMILARITY)
    chance = np.cumsum([dm.math.comb(k, n) * 0.8**n * 0.2**(k - n) for n in range(k + 1)])
    assert chance[least - 1] <= dm.SKETCH_MISS < chance[least] and dm.SKETCH_MISS < (1 - 0.8**dm.ROWS) ** dm.BANDS / 1000
