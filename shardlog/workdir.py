"""Where jobs keep tables that must outlive an executor."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from shardlog.sources.files import remove

# folders and tables of the scope that this thread is in; streams have threads of their own
_scope: ContextVar[tuple[list[str], list[str]] | None] = ContextVar("scope", default=None)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared ``spark.checkpoint.dir``.

    Where that setting is absent, a session on one machine uses its warehouse folder; on a
    cluster that folder may lie on the driver alone, so the setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/shardlog/{name}-{uuid.uuid4().hex}"
    if scope := _scope.get():
        scope[0].append(path)
    return path


def named_table(name: str) -> str:
    """``name``, a table that the scope around drops."""
    if scope := _scope.get():
        scope[1].append(name)
    return name


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what operators store in between, results that are still lazy included.

    Write what is to last to a place of your own before the end.  Without such a scope
    nothing is removed: results may still read it.
    """
    paths, tables = scope = [], []
    before = _scope.set(scope)
    try:
        yield
    finally:
        _scope.reset(before)
        for table in tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in paths:
            remove(spark, path)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: computed once, lineage cut."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
