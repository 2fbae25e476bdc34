"""Whole folders that become visible at once, in any store that Spark can write to."""

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

RUNS = "_runs"  # a name that Spark's readers pass over


def _place(spark: SparkSession, path: str):
    """The Hadoop path, with scheme and authority, and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return store.makeQualified(place), store


def exists(spark: SparkSession, path: str) -> bool:
    place, store = _place(spark, path)
    return store.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    place, store = _place(spark, path)
    store.delete(place, True)


def publish(spark: SparkSession, run: str, target: str) -> bool:
    """Rename ``run`` to ``target``, unless that is there already; tells whether it did.

    The rename is one step of the file system (HDFS, ABFS, a local disk), and fails where
    the target exists, so of two runs of one batch the first that is complete counts.
    """
    (source, _), (goal, store) = _place(spark, run), _place(spark, target)
    store.mkdirs(goal.getParent())
    fs = spark._jvm.org.apache.hadoop.fs
    names = fs.FileContext.getFileContext(goal.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    plainly = spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        names.rename(source, goal, plainly)
    except Py4JJavaError:
        if not store.exists(goal):
            raise
        store.delete(source, True)
        return False
    return True


def write_once(spark: SparkSession, root: str, part: str, write: Callable[[str], None]) -> bool:
    """Let ``write`` fill the folder ``root/part`` whole, or find it there; tells whether it wrote.

    Until the folder is complete it lies beside the data, where readers do not look: a run
    that is cut off is never read, and one that comes again finds that the first one counts.
    File names stay what they were, so a stream that follows the folder reads them once.
    What runs that were cut off leave below ``_runs`` can be removed while nobody writes.
    """
    target = f"{root}/{part}"
    if exists(spark, target):
        return False
    run = f"{root}/{RUNS}/{uuid.uuid4().hex}"
    write(run)
    return publish(spark, run, target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text in one file, in place of what it held; readers find the one or the other."""
    place, store = _place(spark, path)
    beside, _ = _place(spark, f"{path}.{uuid.uuid4().hex}")
    out = store.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs = spark._jvm.org.apache.hadoop.fs
    over = spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    over[0] = getattr(fs, "Options$Rename").OVERWRITE
    fs.FileContext.getFileContext(place.toUri(), spark._jsparkSession.sessionState().newHadoopConf()).rename(beside, place, over)


def read_text(spark: SparkSession, path: str) -> str | None:
    """What ``write_text`` put there."""
    place, store = _place(spark, path)
    if not store.exists(place):
        return None
    found = store.open(place)
    try:
        return bytes(found.readAllBytes()).decode()
    finally:
        found.close()
