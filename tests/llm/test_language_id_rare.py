import numpy as np
import pytest
from pyspark.sql import functions as F

from tabreg.llm import language_id as li

COMMON = ["the house and the garden of the other man", "this is the thing that they said to their mother"]
RARE = "zyx qwvu xyzq uvqw zyxq wvuz qxyz vuwq"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, COMMON[i % 2], "en", "a") for i in range(600)] + [(1000, RARE, "qq", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_a_rare_language_is_fitted_whatever_the_size_of_the_table(docs):
    """One row of 601, and a bound of 5 rows: the common language is sampled, the rare one is not."""
    model = li.fit_text_model(docs, "text", "lang", "doc_id", ["en", "qq"], fit_rows=5)
    assert li.fitted_languages(model, ["en", "qq"]) == ["en", "qq"]
    alone = li.fit_text_model(docs.where("lang = 'qq'"), "text", "lang", "doc_id", ["qq"], fit_rows=5)
    codes = li._trigrams([RARE])[1]
    assert model[2][codes].mean() > model[0][codes].mean() + 0.5 and alone[1][codes].mean() > alone[0][codes].mean()
    kept = li.keep_identified(docs, fit_rows=5)
    assert kept.where("lang = 'qq'").count() == 1 and kept.where("lang = 'en'").count() == 600


def test_rows_of_a_language_without_a_model_are_kept(spark, docs, monkeypatch):
    few = lambda rows, label: ["en"]
    monkeypatch.setattr(li, "languages_of", few)
    more = docs.unionByName(spark.createDataFrame([(1001, "12 %", "qq", "b"), (1002, None, "qq", "b")], docs.schema))
    assert sorted(r.doc_id for r in li.keep_identified(more).where("lang = 'qq'").collect()) == [1000]
    pages = spark.createDataFrame([(i, "http://a.b/", f'<html lang="{x}">{RARE}</html>') for i, x in enumerate(["qq", "xx"])],
                                  "page_id long, url string, html string")
    got = {r.page_id: r.accepted for r in li.identify_pages(pages, more).collect()}
    assert got == {0: True, 1: False}


def test_unfitted_rows_equal_the_row_alone(docs):
    model = li.fit_text_model(docs, "text", "lang", "doc_id", ["en", "none"])
    assert np.array_equal(model[2], model[0]) and li.fitted_languages(model, ["en", "none"]) == ["en"]
    assert docs.where(F.col("lang") == "none").isEmpty()
