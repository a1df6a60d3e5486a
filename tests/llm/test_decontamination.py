import hashlib
import random
import re

from tabreg.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            wins.setdefault(tuple(w[i:i + m]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for m in {len(x) for x in wins}:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in wins:
                    hit.update(range(i, i + m))
                    found |= wins[tuple(w[i:i + m])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def key(row):
    return tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in row)


def check(docs, items, **how):
    got = [tuple(r) for r in dc.contaminated(docs, items, **how).collect()]
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], how.get("window", 10))
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


def test_equals_brute_force(spark, sf_docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = check(sf_docs, items)
    assert 0 < sum(r[5] for r in got) < len(got) / 2


def test_random_texts(spark):
    rng = random.Random(5)

    def text(n):
        return " ".join(rng.choice("abcd") for _ in range(n))
    docs = spark.createDataFrame([(i, text(rng.randint(0, 60))) for i in range(80)], "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(i, text(rng.choice((1, 2, 3, 4, 5, 6, 12)))) for i in range(30)], "item_id long, text string")
    check(docs, items, window=4, shingle=2)
    check(docs, items, window=6, shingle=3, limit=0)  # every join by shuffles


def test_hot_passage(spark):
    passage = " ".join(f"p{i % 17}x{i}" for i in range(30))
    docs = spark.createDataFrame([(i, f"q{i} {passage if i % 3 else ''} end") for i in range(90)], "doc_id long, text string")
    items = spark.createDataFrame([(i, passage) for i in range(12)] + [(99, "end")], "item_id long, text string")
    got = check(docs, items, limit=5)
    assert {r[3] for r in got} == {1, 13}


def test_odd_rows(spark, odd_docs):
    items = spark.createDataFrame([(1, "ALPHA, beta-gamma"), (None, "one two"), (2, None), (3, ""), (4, "!?"), (5, "日本語 テキスト"),
                                   (5, "déjà VUE"), (1, "ALPHA, beta-gamma"), (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda")],
                                  "item_id long, text string").selectExpr("*", "1 as window", "2 as row")
    got = check(odd_docs, items)
    assert len(got) == odd_docs.count() and any(r[5] for r in got)
    assert dc.contaminated(odd_docs.where("false"), items).count() == 0
    assert not any(r[5] for r in check(odd_docs, items.where("false")))
