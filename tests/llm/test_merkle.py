import hashlib
import zlib

from tabreg.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def sides(tree, i):
    out = []
    for nodes in tree[:-1]:
        out.append((i % 2 == 1, nodes[i ^ 1] if (i ^ 1) < len(nodes) else None))
        i //= 2
    return out


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) by plain loops."""
    per = {}
    for r in rows:
        per.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf_of([r.doc_id, r.source, r.lang, r.n_chars, r.text]), r))
    langs = sorted(per, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels([n[2] for n in sorted(per[x], key=lambda n: n[:3])]) for x in langs}
    above = levels([trees[x][-1][0] for x in langs])
    out = []
    for j, x in enumerate(langs):
        for i, (_, _, leaf, r) in enumerate(sorted(per[x], key=lambda n: n[:3])):
            path = sides(trees[x], i) + sides(above, j)
            acc = leaf
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None:
                acc = leaf_of([r.doc_id, r.source, r.lang, r.n_chars + 1, r.text])
            for left, sib in path:
                acc = H(acc) if sib is None else H(sib, acc) if left else H(acc, sib)
            root = above[-1][0]
            out.append((r.doc_id, leaf, trees[x][-1][0], root, H(*[s for _, s in path if s]), acc, acc == root))
    return out


def key(row):
    return tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in row)


def check(docs):
    got = [tuple(r) for r in merkle.verified(docs).collect()]
    assert sorted(got, key=key) == sorted(brute(docs.collect()), key=key)
    return got


def test_equals_brute_force(spark, sf_docs):
    got = check(sf_docs.repartition(5))
    assert {r[6] for r in got} == {True, False}


def test_sizes_around_steps(spark):
    for n in (1, 33, 1030):
        docs = spark.createDataFrame([(i * 3, f"t{i}", "en" if i % 4 else "de", "s", i) for i in range(n)],
                                     "doc_id long, text string, lang string, source string, n_chars long")
        check(docs)


def test_odd_rows(spark, odd_docs):
    got = check(odd_docs)
    assert len(got) == odd_docs.count()
    assert merkle.verified(odd_docs.where("false")).count() == 0
    check(spark.createDataFrame([(7, "x", None, None, None)] * 50, odd_docs.select("doc_id", "text", "lang", "source", "n_chars").schema))


def test_many_parts(spark):
    check(spark.createDataFrame([(i, "t", f"l{i % 37}é", None, 1) for i in range(90)],
                                "doc_id long, text string, lang string, source string, n_chars long"))


def test_shuffled_joins_give_the_same(spark, sf_docs, monkeypatch):
    monkeypatch.setattr(merkle, "sized", lambda df, n: df)
    check(sf_docs.limit(150))
