"""Micro-batches of several writers side by side under one path.

A writer has an id, stored with its checkpoint, and every micro-batch has a folder of
its own below it, which appears when it is complete and then stays as it is: a batch that
runs twice finds it.  Writers never touch each other's.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shardlog.sources.files import write_once

AT_ONCE = {"processingTime": "0 seconds"}


def folder(path: str, writer: str, batch_id: int) -> str:
    return f"{path}/writer={writer}/batch_id={batch_id}"


def save_once(rows: DataFrame, path: str, writer: str, batch_id: int) -> None:
    """One micro-batch as Parquet, whole or not at all."""
    write_once(rows.sparkSession, path, f"writer={writer}/batch_id={batch_id}", rows.write.parquet)


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the writer that owns this checkpoint, made at its first start.

    It lies inside the checkpoint: a checkpoint that begins anew is another writer.
    """
    named = spark.createDataFrame([(uuid.uuid4().hex,)], "writer string").coalesce(1)
    write_once(spark, checkpoint, "writer", named.write.parquet)
    return spark.read.schema("writer string").parquet(f"{checkpoint}/writer").first()["writer"]


def write_batches(
    rows: DataFrame,
    save: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a stream whose micro-batches go through ``save(batch, writer, batch_id)``."""
    writer = writer_of(rows.sparkSession, checkpoint)
    return (
        rows.writeStream.foreachBatch(lambda batch, batch_id: save(batch, writer, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AT_ONCE))
        .start()
    )
