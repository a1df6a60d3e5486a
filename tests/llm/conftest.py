import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from tabreg.llm.common import ship_package
    from tabreg.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="tabreg-llm-tests")
    ship_package(s)
    yield s
    # the session is shared with the other tests; the last one to use it ends with the process


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, an empty and a blank text, repeated rows, copies, and a clashing extra column."""
    long = " ".join(f"w{i % 977}" for i in range(6000))
    rows = [(1, "Alpha beta gamma delta epsilon zeta eta.", "en", "a", 1), (1, "Alpha beta gamma delta epsilon zeta eta.", "en", "a", 1),
            (2, None, "en", None, None), (3, "", None, "b", 0), (4, "   \n\t ", "fr", "b", 4), (None, "one two three", None, None, None),
            (5, "alpha  BETA gamma delta epsilon zeta eta.", "en", "b", 40), (6, long, "en", "a", len(long)),
            (7, "une école à l'été déjà vue", "fr", "b", 26), (8, "日本語 テキスト 😀", None, "c", 12)]
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, DOCS).withColumn("tokens", F.lit("clash")).withColumn("_lang_id", F.lit(1))
