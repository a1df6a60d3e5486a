"""How the suffix tree's words, contexts and asked keys reach its tasks."""

import numpy as np

from tabreg.llm import suffix_tree_lm as stl
from tabreg.sources import scratch


def test_asked_keys_are_joined_part_by_part(spark, monkeypatch):
    """All at once, their rows took more disk than the texts."""
    names, cut = [], stl.cut
    monkeypatch.setattr(stl, "cut", lambda df, name: names.append(name) or cut(df, name))
    docs = spark.createDataFrame([(i, "a b c d a b c d e f " * 5 + f"w{i}") for i in range(40)], "doc_id long, text string")
    with scratch.Scratch(spark, "run"):
        assert stl.fit_and_score(docs, hot_entries=0).count() == 40
    assert names[-6:] == ["pst-asked", *["pst-told"] * 4, "pst-scores"]
    assert names.count("pst-table") == 2 and "pst-kept" not in names  # a context and what follows it are judged in one place


def test_tokens_are_split_and_hashed_as_bytes():
    texts = ["", "One two x\x0btwo  ONE\n", " \t", "ÉtÉ one", "z"]
    doc, pos, w = stl.tokens(texts)
    want = [t.encode().translate(stl._LOWER).split() for t in texts]
    assert doc.tolist() == [i for i, x in enumerate(want) for _ in range(len(x) + 1)]
    assert pos.tolist() == [j for x in want for j in range(len(x) + 1)]
    assert w.tolist() == [h for x in want for h in [*stl._HASHES.array(x).tolist(), int(stl._END)]]


def test_many_words_have_the_hashes_of_few():
    words = np.array([f"w{i}".encode() for i in range(stl.REMEMBERED + 1)], object)
    assert stl._hashes(words)[:9].tolist() == stl._hashes(words[:9]).tolist()
