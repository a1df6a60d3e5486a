from tabreg.plans.fixtures import spread


def test_one_row_group_is_dealt_out(spark, tmp_path):
    path = str(tmp_path / "one.parquet")
    spark.range(1000).coalesce(1).write.parquet(path)
    df = spread(spark.read.parquet(path), rows_per_partition=100)
    assert df.rdd.getNumPartitions() == 10
    assert sorted(r.id for r in df.collect()) == list(range(1000))
