"""Session helpers.

The library never creates or stops the caller's session. ``local_session``
exists only for tests, the bench and examples. ``shared_dir`` gives every
writer in the library a folder inside the cluster's shared checkpoint
location, so nothing is written to a machine-local temporary folder on a
cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "tabreg", memory: str = "16g",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, loopback only)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        # Large task results (tree split statistics) travel through the block
        # manager; on a loopback-only host both addresses must be pinned.
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Fall back from whole-stage codegen when a stage's generated method
        # passes HotSpot's JIT limit (8000 bytes of bytecode); past it the
        # method runs interpreted. The wide flight projection + cleaning stage
        # ran 3x slower without this. Recommended on clusters too.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def active_session() -> SparkSession:
    """The caller's session, also from driver threads that have none bound."""
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def _size_mb(text: str) -> float:
    """'16g' / '1024m' / '512k' / bytes -> MB (Spark's size suffixes)."""
    t = text.strip().lower().rstrip("b")
    units = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1024 * 1024}
    if t and t[-1] in units:
        return float(t[:-1]) * units[t[-1]]
    return float(t) / (1024 * 1024)


def task_memory_mb(spark: SparkSession, share: float = 0.25) -> float:
    """Memory one concurrent task may use outside Spark's managed pools.

    From public settings only: the executor heap (the driver's heap in local
    mode, where the driver runs the tasks) times ``share``, divided by the
    tasks that run at once in that JVM.
    """
    sc = spark.sparkContext
    conf = sc.getConf()
    if sc.master.startswith("local"):
        heap = _size_mb(conf.get("spark.driver.memory", "1g"))
        tasks = sc.defaultParallelism
    else:
        heap = _size_mb(conf.get("spark.executor.memory", "1g"))
        tasks = int(conf.get("spark.executor.cores", "1")) // max(1, int(conf.get("spark.task.cpus", "1")))
    return heap * share / max(1, tasks)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session. Only when it is unset on a local master (tests,
    the bench) does this set one under the local temp folder; on a cluster
    an unset value is an error, because a machine-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; tabreg writes intermediate tables and "
            "models under it and needs a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tabreg-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tabreg/{name}-{uuid.uuid4().hex[:12]}"
