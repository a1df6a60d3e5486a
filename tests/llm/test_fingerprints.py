import hashlib

from pyspark.sql import functions as F

from tabreg.llm import fingerprints as fp


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def edited(docs):
    """Brute force of the contract: next by descending id, after the last the first."""
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for i, (k, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        out[k] = (t, t[:len(t) - half] + nxt[:half], nxt)
    return out


def test_pairs_equal_brute_force(spark, sf_docs):
    rows = sf_docs.select("doc_id", "text").collect()
    want = edited([(r.doc_id, r.text) for r in rows])
    got = fp.edited_pairs(sf_docs).collect()
    assert len(got) == len(rows)
    errors = []
    for r in got:
        text, changed, nxt = want[r.doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        a, b = shingle_set(text), shingle_set(changed)
        true = len(a & b) / len(a | b) if a | b else 1.0
        errors.append(abs(r.near_edited - true))
        n = shingle_set(nxt)
        assert abs(r.near_next - (len(a & n) / len(a | n) if a | n else 1.0)) < 0.25
        assert abs(r.distinct_shingles / max(1, len(a)) - 1) < 0.5 or len(a) <= 1
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.03


def test_small_fingerprints_are_exact(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f h")], "doc_id long, text string")
    got = fp.with_fingerprints(docs, {"f": "text"})
    a, b = [r.f for r in got.orderBy("doc_id").collect()]
    assert len(a) == len(b) == 3 and a == sorted(a) and len(set(a) & set(b)) == 2
    one = got.groupBy().agg(F.min_by("f", "doc_id").alias("a"), F.max_by("f", "doc_id").alias("b"))
    r = one.select(fp.resemblance(F.col("a"), F.col("b")), fp.containment(F.col("a"), F.col("b"))).first()
    assert r[0] == 0.5 and abs(r[1] - 2 / 3) < 1e-12


def test_odd_rows(spark, odd_docs):
    got = fp.edited_pairs(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[2][0].n_chars == 0 and by[2][0].fingerprint == "" == by[4][0].fingerprint
    assert len({r.fingerprint for r in by[1]}) == 1 == len({r.fingerprint for r in by[1] + by[5]})
    assert by[2][0].near_edited == 1.0 and all(0 <= r.near_next <= 1 for r in got)


def test_empty_and_single(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fp.edited_pairs(none).count() == 0
    one = fp.edited_pairs(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def test_parts_merge_into_the_whole(spark):
    text = " ".join(f"w{i}" for i in range(900))
    words = text.split()
    parts = [(1, " ".join(words[i:i + 104])) for i in range(0, 900, 100)]  # parts overlap by four words
    whole = fp.with_fingerprints(spark.createDataFrame([(1, text)], "k long, text string"), {"f": "text"}).first().f
    split = fp.with_fingerprints(spark.createDataFrame(parts, "k long, text string").repartition(3), {"f": "text"})
    assert fp.merge_groups(split, ["k"], "f").first().f == whole
    assert len(whole) == fp.K


def test_plan_is_native(spark, sf_docs):
    plan = fp.edited_pairs(sf_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
