import os

import pytest
from pyspark.sql import functions as F

from tabreg.session import checkpoint_root
from tabreg.sources import scratch


def folders(spark):
    root = checkpoint_root(spark).removeprefix("file:") + "/tabreg"
    return {os.path.join(d, x) for d, names, _ in os.walk(root) for x in names} if os.path.isdir(root) else set()


def test_success_leaves_only_what_the_result_reads(spark):
    before = folders(spark)
    with scratch.Scratch(spark, "run") as run:
        a = run.cut(spark.range(10), "a")
        b = run.cut(a.withColumn("x", F.col("id") * 2), "b")
        run.drop(a)
        assert len(run.paths()) == 1
        c = run.cut(b.where("x > 4"), "c")
        run.keep(c)
    assert c.count() == 7
    assert len(folders(spark) - before) == 2  # the run's folder and one table
    assert len(scratch.leftovers(spark)) == 1
    scratch.release(spark)
    assert folders(spark) == before and not scratch.leftovers(spark)


def test_error_leaves_nothing(spark):
    before = folders(spark)
    with pytest.raises(ValueError):
        with scratch.Scratch(spark, "run") as run:
            run.keep(run.cut(spark.range(3), "a"))
            raise ValueError
    with pytest.raises(Exception, match="boom"):
        with scratch.Scratch(spark, "run") as run:
            run.cut(spark.range(3).select(F.raise_error(F.lit("boom"))), "b")
    assert folders(spark) == before


def test_inner_scope_hands_over_to_the_outer(spark):
    before = folders(spark)

    @scratch.scoped
    def inner():
        gone, kept = scratch.cut(spark.range(5), "gone"), scratch.cut(spark.range(6), "kept")
        assert gone.count() == 5
        scratch.keep(kept)
        return kept

    with scratch.Scratch(spark, "outer") as run:
        t = inner()
        assert t.count() == 6 and len(run.paths()) == 1
    assert folders(spark) == before


def test_without_a_scope_tables_stay_until_release(spark):
    before = folders(spark)
    t = scratch.cut(spark.range(4), "t")
    scratch.drop(t)
    assert t.count() == 4
    scratch.release(spark)
    assert folders(spark) == before
