import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabreg.llm import queries
from tabreg.session import checkpoint_root
from tabreg.sources import scratch

from .conftest import ROOT, SF0001


def test_stages_follow_one_another(spark, sf_docs):
    docs, counts = sf_docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF0001)
        assert docs.columns == sf_docs.columns
        docs = docs.cache()
        counts.append(docs.count())
        assert docs.join(sf_docs, "doc_id", "left_semi").count() == counts[-1]
    assert counts == sorted(counts, reverse=True) and counts[1] < counts[0]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF0001).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}
    run = corpus_pipeline.run(spark, SF0001).collect()
    assert {(p.doc_id, p.start, p.length, p.ids_crc32) for p in run if p.start == 0} <= {
        (p.doc_id, p.start, p.length, p.ids_crc32) for p in pieces} | {(p.doc_id, p.start, p.length, p.ids_crc32) for p in run}
    assert {p.doc_id for p in run} == {p.doc_id for p in pieces}


def test_empty_and_odd_documents(spark, odd_docs):
    for docs in (odd_docs, odd_docs.where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF0001)
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF0001).count() >= docs.count()


CLASHING = ["_row", "_k", "_r", "_n", "_l", "_salt", "_doc", "_lang_id", "_lang_host", "_lang_accepted", "_mix_tokens", "_mix_source",
            "_mix_sampled", "key", "row", "node", "label", "bucket", "tokens", "class_id", "doc", "nth", "odd.name"]


def test_columns_of_any_name_keep_their_values(spark, sf_docs):
    extra = {c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHING}
    docs = sf_docs.unionByName(sf_docs.where("doc_id < 3")).withColumns(extra)  # some rows twice
    plain = sf_docs.unionByName(sf_docs.where("doc_id < 3"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF0001)
        assert out.columns == docs.columns
        rows = [r.asDict() for r in out.collect()]
        assert rows and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in CLASHING)
        assert sorted(r["doc_id"] for r in rows) == sorted(r.doc_id for r in stage(spark, plain, SF0001).collect())


def test_a_run_keeps_one_stage_and_an_error_nothing(spark, monkeypatch):
    def tables():
        root = checkpoint_root(spark).removeprefix("file:") + "/tabreg"
        return {os.path.join(d, x) for d, names, _ in os.walk(root) for x in names}
    scratch.release(spark)
    before = tables()
    assert corpus_pipeline.run(spark, SF0001).count()
    assert sorted(os.path.basename(t)[:6] for t in tables() - before) == ["pipeli", "stage-"]
    scratch.release(spark)
    assert tables() == before

    def broken(*_):
        raise ValueError("stop")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [*corpus_pipeline.STAGES[:2], ("mixing", broken), corpus_pipeline.STAGES[3]])
    with pytest.raises(ValueError, match="stop"):
        corpus_pipeline.run(spark, SF0001)
    assert tables() == before


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "mixing", "packing"]


def test_entry_without_these_modules():
    """The other queries stay when this subpackage and the pipeline are gone."""
    code = ("import sys, importlib.util as u; find = u.find_spec; "
            "u.find_spec = lambda n, *a: None if n.startswith(('tabreg.llm', 'corpus_pipeline')) else find(n, *a); "
            f"sys.path.insert(0, {ROOT!r}); import __spark_entry__ as e; assert len(e.queries()) == len(e.oracle_sql()) >= 40, len(e.queries()); "
            "assert not any(m.startswith('tabreg.llm') for m in sys.modules)")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
