"""Reading a stream from LATEST: the marks are frozen once and survive restarts."""

from pyspark.sql import DataFrame

from shardlog.operators.checkpoint import checkpoint
from shardlog.operators.positions import from_latest
from shardlog.schema import CHECKPOINT
from shardlog.sources.files import write_once


def freeze_marks(stored: DataFrame, path: str) -> DataFrame:
    """High-water mark per shard of what is stored now, computed at the first start only.

    Later calls with the same ``path`` return the marks of the first one; a mark
    taken anew at a restart would skip what arrived in between.  They are there whole
    or not at all, and only their absence makes them be taken.
    """
    spark = stored.sparkSession
    write_once(spark, path, "marks", lambda run: checkpoint(stored).coalesce(1).write.parquet(run))
    return spark.read.schema(CHECKPOINT).parquet(f"{path}/marks")


def read_latest(records: DataFrame, stored: DataFrame, marks_path: str) -> DataFrame:
    """Only records behind the frozen marks; new shards pass whole."""
    return from_latest(records, freeze_marks(stored, marks_path))
