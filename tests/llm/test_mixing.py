import duckdb
import pytest
from pyspark.sql import functions as F

from tabreg.llm import mixing

from .conftest import SF0001


def margins(rows, dim, weight):
    out = {}
    for r in rows:
        out[r[dim]] = out.get(r[dim], 0.0) + r["_mix_tokens"] * weight(r)
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


def test_margins_meet_their_targets(spark, sf_docs):
    targets = {"lang": {"en": 0.25, "de": 0.25, "fr": 0.25, "es": 0.25}, "source": {f"src{i}": 0.05 for i in range(20)}}
    rows = mixing.mix(sf_docs, mixing.document_dims(), powers={"topic": 0.8}, targets=targets).collect()
    assert rows[0]["_mix_error"] <= mixing.TOLERANCE
    lang = margins(rows, "_mix_lang", lambda r: r["_mix_weight"])
    source = margins(rows, "_mix_source", lambda r: r["_mix_weight"])
    topic, plain = margins(rows, "_mix_topic", lambda r: r["_mix_weight"]), margins(rows, "_mix_topic", lambda r: 1.0)
    goal = {k: v**0.8 for k, v in plain.items()}
    assert all(abs(lang[k] - 0.25) < 1e-3 for k in lang) and all(abs(source[k] - 0.05) < 1e-3 for k in source)
    assert all(abs(topic[k] - goal[k] / sum(goal.values())) < 1e-3 for k in topic)
    tokens = sum(r["_mix_tokens"] for r in rows)
    expected = sum(r["_mix_tokens"] * r["_mix_probability"] for r in rows)
    assert expected == pytest.approx(mixing.KEEP_SHARE * tokens, rel=1e-6)
    assert all(0 <= r["_mix_probability"] <= 1 for r in rows)


def test_oracle(spark, sf_docs):
    from tabreg.llm import queries
    got = queries.QUERIES["op7_mixing"](spark, SF0001).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF0001}/documents.parquet')")
    want = con.execute(mixing.oracle_sql()).df().sort_values("doc_id").reset_index(drop=True)
    assert got["sampled"].tolist() == want["sampled"].tolist() and got["topic"].tolist() == want["topic"].tolist()
    for c in ("tokens", "weight", "probability"):
        assert got[c].tolist() == pytest.approx(want[c].tolist())


def test_shuffled_lookup_gives_the_same(spark, sf_docs, monkeypatch):
    a = mixing.mix(sf_docs, mixing.document_dims()).select("doc_id", "_mix_weight", "_mix_sampled").collect()
    monkeypatch.setattr("tabreg.llm.mixing.lookup_join",
                        lambda rows, small, keys, n: __import__("tabreg.llm.common", fromlist=["x"]).lookup_join(rows, small, keys, n, limit=0))
    b = mixing.mix(sf_docs, mixing.document_dims()).select("doc_id", "_mix_weight", "_mix_sampled").collect()
    a, b = ({r.doc_id: (round(r._mix_weight, 9), r._mix_sampled) for r in x} for x in (a, b))
    assert a == b


def test_odd_rows(spark, odd_docs):
    rows = mixing.mix(odd_docs, mixing.document_dims())
    assert set(odd_docs.columns) < set(rows.columns)
    got = rows.collect()
    assert len(got) == odd_docs.count() and all(r["_mix_weight"] is not None for r in got)
    assert [r["_mix_tokens"] for r in got if r.doc_id == 3] == [0]
    assert mixing.mix(odd_docs.where("false"), mixing.document_dims()).count() == 0
    assert mixing.mix(odd_docs, mixing.document_dims(), keep_share=1.0, powers={}).where(~F.col("_mix_sampled")).where("_mix_tokens > 0").count() == 0


def test_plan_is_native(spark, sf_docs):
    plan = mixing.mix(sf_docs, mixing.document_dims())._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_targets_that_cannot_meet_end_with_their_error(spark):
    """Sources of one language each, with targets that no weights reach: the error is told."""
    rows = [(i, "w " * (1 + i % 7), ["en", "de"][i % 2], f"s{i % 40}", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    dims = {"source": F.col("source"), "lang": F.col("lang")}
    got = mixing.mix(docs, dims, targets={"source": {f"s{i}": 1 / 40 for i in range(40)}, "lang": {"en": 0.9, "de": 0.1}}).collect()
    assert len(got) == 400 and got[0]["_mix_error"] > 0.1
    fits = mixing.mix(docs, dims, targets={"source": {f"s{i}": 1 / 40 for i in range(40)}, "lang": {"en": 0.5, "de": 0.5}}).collect()
    assert fits[0]["_mix_error"] <= mixing.TOLERANCE
