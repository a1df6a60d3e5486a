"""The driver contract, and every oracle against Spark at sf0.001."""

import importlib.util
import os

import duckdb
import pytest

from conftest import ROOT, SF0001

from tabreg.plans import catalog

spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)

import sys  # noqa: E402
sys.path.insert(0, os.path.join(ROOT, "tools"))
from check_oracles import TABLES, frame_hash  # noqa: E402

SLOW = {"train_evaluate", "model_comparison"}
NO_SQL = {"forest_leaves"}  # random draws; tests/test_trees.py routes the rows by hand


def test_keys_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = set(catalog.QUERIES)
    assert own - NO_SQL <= set(o)
    for name in own:
        assert "pipeline" not in name and not name.startswith("op")
    assert all(name == "pipeline" or name.startswith("op") for name in set(q) - own)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_oracle_matches(spark, con, name):
    sp = E.queries()[name](spark, SF0001).toPandas()
    od = con.execute(E.oracle_sql()[name]).df()
    assert len(sp) == len(od)
    assert sorted(sp.columns) == sorted(od.columns)
    assert frame_hash(sp)[0] == frame_hash(od)[0]


def test_preview_rows(spark):
    assert E.queries()["preview"](spark, SF0001).count() == 100


@pytest.mark.parametrize("name", ["cast_double", "mean_impute", "hhmm_to_minutes", "day_part", "preprocess",
                                  "feature_encoding", "bounded_sample"])
def test_oracle_matches_with_ansi_off(spark, con, name):
    """Cast-heavy operators give the same rows when the session runs non-ANSI."""
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        sp = E.queries()[name](spark, SF0001).toPandas()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    od = con.execute(E.oracle_sql()[name]).df()
    assert len(sp) == len(od) and frame_hash(sp)[0] == frame_hash(od)[0]
