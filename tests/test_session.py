"""Session helpers: size parsing, per-task memory, shared folders."""

from tabreg.operators.estimators import tree_memory_mb
from tabreg.session import _size_mb, checkpoint_root, shared_dir, task_memory_mb


def test_size_parsing():
    assert _size_mb("16g") == 16384
    assert _size_mb("1024m") == 1024
    assert _size_mb("512k") == 0.5
    assert _size_mb("1g") == 1024


def test_tree_memory_is_bounded(spark):
    # tests run with a 16 GB heap on 4 local cores: 16384 * 0.25 / 4 > 256 -> Spark's default
    assert task_memory_mb(spark) > 256
    assert tree_memory_mb(spark) == 256
    assert 16 <= tree_memory_mb(spark, ceiling=32) <= 32


def test_shared_dir_under_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b
