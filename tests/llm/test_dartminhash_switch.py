import random

from tabreg.llm import dartminhash as dm
from tabreg.llm import queries

from .conftest import SF0001
from .test_dartminhash import brute, variants


def test_every_column_is_the_same_on_both_sides_of_the_switch(spark):
    """All pairs at once or by leaders: what is returned doesn't depend on how the pairs were found."""
    rnd = random.Random(2)
    rows = list(enumerate(variants(rnd, [f"b{i}" for i in range(120)], 30, 1) + variants(rnd, [f"c{i}" for i in range(90)], 4, 2)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    at_once, by_leaders = (dm.near_duplicates(docs, pairs_per_row=n) for n in (10**6, 0))
    assert at_once.columns == by_leaders.columns == ["doc_id", "row", "class_id", "class_row"]
    got = sorted(tuple(r) for r in at_once.collect())
    assert got == sorted(tuple(r) for r in by_leaders.collect())
    assert [(r[0], r[2]) for r in got] == brute(rows)


def test_query_gives_the_class(spark):
    assert queries.QUERIES["op9_dartminhash"](spark, SF0001).columns == ["doc_id", "class_id"]
