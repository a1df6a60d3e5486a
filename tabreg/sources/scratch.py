"""Intermediate tables with an owner.

A ``Scratch`` owns the tables written below the shared checkpoint folder during
one run. A table is deleted by ``drop`` as soon as what reads it is written;
leaving the scope deletes the rest, also after an error. Only tables that the
returned frame still reads are kept: they pass to the enclosing scope, or,
outside of any, stay until ``release`` or the end of the application.
"""

from __future__ import annotations

import atexit
import functools
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from ..session import active_session, shared_dir
from . import fs

_current: ContextVar[Scratch | None] = ContextVar("scratch", default=None)
#: Folders of tables that returned frames read, by application.
_left: dict[str, list[str]] = {}


#: Spark then deletes the shuffle files of a query as it ends, and not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Scratch:
    """``with Scratch(spark, "name") as run: t = run.cut(df, "part"); ...; run.drop(t)``."""

    def __init__(self, spark: SparkSession, name: str = "run"):
        outer = _current.get()
        self.spark, self.folder = spark, outer.folder if outer else shared_dir(spark, name)
        self._owned: dict[int, tuple[DataFrame, str]] = {}
        self._kept: set[int] = set()

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: no lineage, readable by every executor. Its shuffles go with the write."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:12]}"
        try:
            with _shuffles_freed(self.spark):
                df.write.parquet(path)
        except BaseException:
            fs.remove(self.spark, path)
            raise
        table = self.spark.read.schema(df.schema).parquet(path)
        self._owned[id(table)] = (table, path)
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of this scope; all that reads them must be written."""
        for t in tables:
            entry = self._owned.pop(id(t), None)
            if entry:
                fs.remove(self.spark, entry[1])

    def keep(self, *tables: DataFrame) -> None:
        """The returned frame reads these: they outlive the scope."""
        self._kept.update(id(t) for t in tables)

    def paths(self) -> list[str]:
        return [p for _, p in self._owned.values()]

    def __enter__(self) -> Scratch:
        self._token = _current.set(self)
        return self

    def __exit__(self, error, *_) -> None:
        _current.reset(self._token)
        outer = _current.get()
        kept = {} if error else {i: self._owned.pop(i) for i in list(self._owned) if i in self._kept}
        self.drop(*[t for t, _ in self._owned.values()])
        if outer is not None:
            outer._owned.update(kept)
        elif kept:
            _leave(self.spark, self.folder)
        else:
            fs.remove(self.spark, self.folder)


def _leave(spark: SparkSession, folder: str) -> None:
    _left.setdefault(spark.sparkContext.applicationId, []).append(folder)


def cut(df: DataFrame, name: str) -> DataFrame:
    """``Scratch.cut`` in the enclosing scope; outside of any, the table stays until ``release``."""
    run = _current.get()
    if run is None:
        run = Scratch(df.sparkSession, name)
        _leave(df.sparkSession, run.folder)
    return run.cut(df, name)


def drop(*tables: DataFrame) -> None:
    """``Scratch.drop`` in the enclosing scope, if there is one."""
    run = _current.get()
    if run is not None:
        run.drop(*tables)


def keep(*tables: DataFrame) -> None:
    """``Scratch.keep`` in the enclosing scope, if there is one."""
    run = _current.get()
    if run is not None:
        run.keep(*tables)


def scoped(fn):
    """Run ``fn`` in a scope of its own."""
    @functools.wraps(fn)
    def run(*args, **kwargs):
        with Scratch(active_session(), fn.__name__):
            return fn(*args, **kwargs)
    return run


def leftovers(spark: SparkSession) -> list[str]:
    """Folders kept by frames returned so far in this application."""
    return list(_left.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession) -> None:
    """Delete what returned frames kept; they can't be read any more."""
    for path in _left.pop(spark.sparkContext.applicationId, []):
        fs.remove(spark, path)


@atexit.register
def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        release(spark)
