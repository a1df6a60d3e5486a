import numpy as np
import pytest
from pyspark.sql import functions as F

from tabreg.llm import language_id as li

from .conftest import SF0001


@pytest.fixture(scope="module")
def fitted(spark, sf_docs):
    languages = li.languages_of(sf_docs, "lang")
    model = li.fit_text_model(sf_docs, "text", "lang", "doc_id", languages)
    return languages, model, spark.sparkContext.broadcast(model)


def test_model_rows_are_distributions(fitted):
    languages, model, _ = fitted
    sums = np.exp(model.reshape(len(languages) + 1, -1, 64).astype(float)).sum(2)
    assert np.allclose(sums, 1, atol=1e-4)


def test_held_out_accuracy(spark, sf_docs):
    """Fitted on every second document, right on the others."""
    languages = li.languages_of(sf_docs, "lang")
    model = spark.sparkContext.broadcast(li.fit_text_model(sf_docs.where("doc_id % 2 = 0"), "text", "lang", "doc_id", languages, fit_rows=60))
    rows = sf_docs.where("doc_id % 2 = 1").withColumn("said", F.lit(None).cast("string"))
    got = li.identify(rows, model, languages, "text", F.col("said"), F.lit("")).collect()
    right = sum(r.lang == r._lang_id for r in got)
    assert right >= 0.95 * len(got)


def test_pages(spark):
    pages, docs = (spark.read.parquet(f"{SF0001}/{t}.parquet") for t in ("pages", "documents"))
    got = li.identify_pages(pages, docs).collect()
    assert len(got) == pages.count()
    assert sum(r.language == r.declared for r in got) >= 0.95 * len(got)


def brute(scores, host, sums, declared, languages, total, n_suffixes):
    """The posterior of one row, step by step."""
    k = len(languages)
    n, mean, own = scores[0], np.array(scores[2:2 + k]), np.array(scores[2 + k:])
    prior = (np.array(total) + 1) / (np.array(total) + 1).sum()
    for level in sums:
        left = np.maximum(np.array(level) - own, 0)
        prior = (left + li.SMOOTHING * prior) / (left.sum() + li.SMOOTHING)
    p = np.log(prior) + min(n, li.TEXT_CHARS) * mean
    p += np.log((np.maximum(np.array(sums[0]) - own, 0) + li.SMOOTHING / n_suffixes) / (np.array(total) + li.SMOOTHING))
    if declared in languages:
        p += np.log([li.DECLARED_RIGHT if x == declared else (1 - li.DECLARED_RIGHT) / (k - 1) for x in languages])
    p = np.exp(p - p.max())
    return p / p.sum()


def test_fusion_equals_brute_force(spark, fitted):
    languages, model, shared = fitted
    rows = [(1, "de", "en", "a.example.de"), (2, "thand", None, "b.example.de"), (3, "und der sch", "de-AT", "b.example.de"),
            (4, "x", "fr", "c.fr"), (5, "x", None, "c.fr"), (6, "le la des", "xx", None), (7, None, "es", "c.fr"), (8, "12 %%", None, "c.fr")]
    df = spark.createDataFrame(rows, "id long, text string, said string, host string")
    got = {r.id: r for r in li.identify(df, shared, languages, "text", F.col("said"), F.col("host")).collect()}
    scored = {r.id: r.s for r in df.select("id", li.text_scores(F.col("text"), shared).alias("s")).collect()}
    k = len(languages)
    hosts = {r[0]: (r[3] or "") for r in rows}

    def level(f):
        out = {}
        for i, h in hosts.items():
            out[f(h)] = out.get(f(h), 0) + np.array(scored[i][2 + k:])
        return out
    domain = lambda h: ".".join(h.split(".")[-2:])
    suffix = lambda h: h.split(".")[-1] if "." in h else ""
    by_host, by_domain, by_suffix = level(lambda h: h), level(domain), level(suffix)
    total = sum(by_suffix.values())
    for i, _, said, _ in rows:
        h = hosts[i]
        said = (said or "").lower()[:2]
        want = brute(scored[i], h, [by_suffix[suffix(h)], by_domain[domain(h)], by_host[h]], said, languages, total, len(by_suffix))
        assert got[i]._lang_id == languages[int(want.argmax())]
        assert got[i]._lang_posterior == pytest.approx(want.max(), rel=1e-6)
    assert not got[7]._lang_accepted and not got[8]._lang_accepted and got[3]._lang_accepted
    assert got[7]._lang_text is None


def test_stage_keeps_clean_documents(spark, sf_docs, odd_docs):
    kept = li.keep_identified(sf_docs)
    assert kept.columns == sf_docs.columns and kept.count() == sf_docs.count()
    odd = li.keep_identified(sf_docs.unionByName(odd_docs.select(*sf_docs.columns).where("doc_id in (2, 3, 4)").withColumn("doc_id", -F.col("doc_id"))))
    assert odd.where("doc_id < 0").count() == 0
    extra = li.keep_identified(odd_docs)
    assert extra.columns == odd_docs.columns and extra.where("doc_id = 1").count() == 2
    assert li.keep_identified(odd_docs.where("false")).count() == 0
