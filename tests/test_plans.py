"""Physical-plan shape: pruned scans, no shuffle in row-wise stages, partial aggregation."""

import contextlib
import io as _io

from tabreg.operators import clean, sampling
from tabreg.plans.fixtures import KEYS, flights, table
from tabreg.spec import CONTINUOUS, DROPPED, FeatureSpec
from conftest import SF0001


def plan(df) -> str:
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_cleaning_chain_is_one_stage_without_shuffle(spark):
    p = plan(clean.preprocess(flights(spark, SF0001), FeatureSpec(), impute_means_from="none"))
    assert "Exchange" not in p
    assert "l_discount" not in p and "l_tax" not in p  # scan pruned to the columns used


def test_split_reads_only_key_columns(spark):
    li = table(spark, SF0001, "lineitem")
    p = plan(li.select(*KEYS, sampling.split_column(KEYS, 80).alias("split")))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in p
    assert "Exchange" not in p


def test_means_are_partial_then_final(spark):
    casted = clean.cast_double(clean.drop_columns(flights(spark, SF0001), DROPPED), list(CONTINUOUS))
    p = plan(clean.column_means(casted, list(CONTINUOUS)))
    assert p.count("Exchange (") == 1 and p.count("HashAggregate (") == 2  # tree nodes only


def test_keyed_sample_is_a_pushed_filter_on_the_scan_stage(spark):
    li = table(spark, SF0001, "lineitem")
    p = plan(sampling.bounded_sample(li, max_rows=1000, keys=KEYS, n_rows=6000))
    assert "Exchange" not in p and "Filter" in p
