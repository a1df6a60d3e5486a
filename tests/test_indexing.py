from collections import Counter

from pyspark.sql import functions as F

from tabreg.operators import features, indexing


def table(spark):
    values = ["hot"] * 300 + [f"v{i % 37}" for i in range(200)] + [None] * 40 + ["é", "Z", "a", ""] * 2
    return spark.createDataFrame([(i, v, i) for i, v in enumerate(values)], "id long, c string, _value long").repartition(5)


def want(rows):
    n = Counter(r.c for r in rows if r.c is not None)
    rank = {v: float(i) for i, (v, _) in enumerate(sorted(n.items(), key=lambda x: (-x[1], x[0].encode())))}
    return {r.id: rank.get(r.c, float(len(rank))) for r in rows}


def test_equals_counts_and_spark_indexer(spark):
    df = table(spark)
    index = indexing.fit_string_index(df, "c", partitions=3)
    got = {r.id: r.cIndex for r in index.transform(df).collect()}
    assert got == want(df.collect())
    assert [r[0] for r in index.table.orderBy("index").select("index").collect()] == [float(i) for i in range(index.size)]
    plain = features.string_indexer(["c"]).fit(df).transform(df)
    assert got == {r.id: r.cIndex for r in plain.collect()}


def test_shuffled_join_gives_the_same(spark):
    df = table(spark)
    index = indexing.fit_string_index(df.where("c != 'v3'"), "c")
    a, b = (index.transform(df, limit=n) for n in (10**6, 0))
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert a.columns == ["id", "c", "_value", "cIndex"]
    assert {r.cIndex for r in a.where("c = 'v3' or c is null").collect()} == {float(index.size)}


def test_empty_saved_and_loaded(spark, tmp_path):
    df = table(spark)
    none = indexing.fit_string_index(df.where("false"), "c")
    assert none.size == 0 and {r.cIndex for r in none.transform(df).collect()} == {0.0}
    index = indexing.fit_string_index(df, "c")
    again = indexing.StringIndex.load(spark, index.save(str(tmp_path / "index")), "c")
    assert again.size == index.size
    assert {r.id: r.cIndex for r in again.transform(df).collect()} == want(df.collect())
    numbers = df.select("id", (F.col("id") % 3).alias("c"))
    assert indexing.fit_string_index(numbers, "c").size == 3


def test_large_table_is_joined_by_shuffle(spark):
    # the small file of an index is no reason to broadcast its copies: 8 for each category
    df = table(spark)
    index = indexing.fit_string_index(df, "c")
    plan = index.transform(df, limit=0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
