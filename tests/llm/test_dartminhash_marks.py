import random

import numpy as np
import pytest

from tabreg.llm import dartminhash as dm

from .test_dartminhash import brute, got_of, order, variants


def test_marks_fail_no_link(spark):
    """Over texts of 1 to 6000 units, also of marks of two lengths or of the greatest: the bound is at least what is shared."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        n = int(rng.choice([1, 7, 8, 9, 60, 64, 130, 500, 6000]))
        x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < rng.choice([1, .95, .9, .7])], rng.integers(0, 2**64, int(n * rng.choice([0, .1, .3])), dtype=np.uint64)]))
        linked = 9 * len(np.intersect1d(x, y)) >= 4 * (len(x) + len(y))
        rows.append((bool(linked), len(x), len(y), dm.marks(x).tolist(), dm.marks(y).tolist()))
    docs = spark.createDataFrame(rows, "linked boolean, nx int, ny int, mx array<long>, my array<long>")
    got = [(r.linked, r.may, r.nx) for r in docs.select("*", dm._may_link((4, 5), "mx", "my", "nx", "ny").alias("may")).collect()]
    assert {len(r[3]) for r in rows} >= {1, 2, dm.MOST_MARKS // 64} and any(len(r[3]) == 2 * len(r[4]) for r in rows)
    assert all(may for linked, may, _ in got if linked) and sum(linked for linked, _, _ in got) > 100
    apart = [may for linked, may, n in got if not linked and n >= 60]
    assert len(apart) > 50 and sum(apart) < len(apart) / 3


@pytest.mark.parametrize("each", [dm.PAIRS_PER_ROW, 0])
def test_units_are_read_for_few_pairs(spark, monkeypatch, each):
    """Members of one group, each two alike by 0.6 to 0.75: their sketches agree, but few have their units compared."""
    rnd, base = random.Random(7), [f"b{i}" for i in range(400)]
    texts = []
    for _ in range(40):
        w = list(base)
        for i in rnd.sample(range(400), 14):
            w[i] = f"n{rnd.randrange(10**6)}"
        texts.append(" ".join(w))
    rows = list(enumerate(texts + variants(rnd, texts[5].split(), 3, 2)))
    compared, compare = [], dm._compare
    monkeypatch.setattr(dm, "_compare", lambda pairs, *more: (compared.append(pairs.count()), compare(pairs, *more))[1])
    got = dm.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), pairs_per_row=each)
    assert order(got_of(got)) == order(brute(rows))
    assert 0 < sum(compared) < 200  # of about 900 pairs


def test_texts_are_not_shuffled_for_few_others(spark):
    """The rows that don't represent their class are few and counted: the texts are held against them as they are read."""
    rows = [(i, f"{i} " + " ".join(f"w{i}x{j}" for j in range(9)), "s") for i in range(40)] + [(90, "same text", "a"), (91, "same text", "b"), (91, "same text", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = dm.drop_near_duplicates(docs.where("doc_id != 91"))
        plan = kept._jdf.queryExecution().toString()
        assert "SortMergeJoin" not in plan and "LeftAnti" in plan
        assert kept.count() == 41
        assert sorted(r.doc_id for r in dm.drop_near_duplicates(docs).collect()) == [*range(40), 90]
        null = spark.createDataFrame([(None, "a b", "x"), (None, "a b", "x"), (None, "A b", "y"), (1, "a  b", "z")], docs.schema)
        assert [r.doc_id for r in dm.drop_near_duplicates(null).collect()] == [1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
