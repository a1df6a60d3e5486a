"""What the suffix tree leaves on disk and lets through its filter."""

import time
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from tabreg.llm import suffix_tree_lm as stl
from tabreg.sources import scratch


def test_only_what_the_result_reads_stays(spark):
    docs = spark.createDataFrame([(i, "a b c d a b c d e f " * 5 + f"w{i}") for i in range(40)], "doc_id long, text string")
    with scratch.Scratch(spark, "run") as run:
        out = stl.fit_and_score(docs, depth=2)
        names = sorted(Path(p).name.rsplit("-", 1)[0] for p in run.paths())
        assert names == ["pst-scores", "pst-table", "pst-table", "pst-unigrams"]
        assert out.count() == 40
    with scratch.Scratch(spark, "run") as run:
        model = stl.fit(docs, depth=2)
        assert len(run.paths()) == 3 and stl.score(docs, model, depth=2).count() == 40


def test_a_written_table_leaves_no_shuffle_files(spark):
    top = Path(spark.sparkContext._temp_dir).parent.parent

    def files():
        return set(top.glob("blockmgr-*/*/shuffle_*"))

    before = files()
    with scratch.Scratch(spark, "run") as run:
        t = run.cut(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "count"), "t")
        for _ in range(50):
            if not files() - before:
                break
            time.sleep(0.1)
        assert not files() - before
        assert t.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_filter_lets_few_other_keys_through(spark):
    rng = np.random.default_rng(5)
    keys, others = rng.integers(0, 2**63, 60_000, np.uint64) * np.uint64(2), rng.integers(0, 2**63, 60_000, np.uint64) * np.uint64(2) + np.uint64(1)
    table = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key long")
    none = np.zeros(0, np.uint64)
    lookup = stl._Lookup(none, none.astype(float), *stl._filter_of(table))
    assert lookup.maybe(keys).all()
    assert lookup.maybe(others).mean() < 0.01
