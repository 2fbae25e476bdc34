"""Handle a stream's messages with a user function, continuously."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shardlog.operators.consume import for_each_message, message_counts, observe_messages
from shardlog.operators.produce import admit, admit_into, capacity
from shardlog.schema import SHARD_KEYS
from shardlog.sources.files import remove, write_once
from shardlog.streaming.writers import folder, save_once, write_batches
from shardlog.workdir import materialised

_OUTCOME = "stream string, shard_id string, sequence_number string, value {}, error_message string"
READ_PACE = {"processingTime": "500 milliseconds"}
Drained = Callable[[SparkSession, int], DataFrame]


def listen(
    records: DataFrame,
    fn: Callable[[bytes], object],
    result_type: str | T.DataType,
    path: str,
    checkpoint: str,
    concurrency: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Call ``fn`` with each payload and keep its outcomes, errors included, at ``path``.

    The default trigger fetches twice a second.  ``handled_counts`` tells how many
    messages were handed over since the first start.  ``concurrency`` is the number of
    tasks; without it a micro-batch is dealt out by its size, also when one file or one
    partition of the source brings all of it.
    """

    def save(batch: DataFrame, writer: str, batch_id: int) -> None:
        if concurrency is None:
            batch = batch.select(*SHARD_KEYS, "sequence_number", "data").hint("rebalance")
        save_once(for_each_message(batch, fn, result_type, concurrency), path, writer, batch_id)

    return write_batches(observe_messages(records), save, checkpoint, trigger or READ_PACE)


def outcomes(spark: SparkSession, path: str, result_type: str) -> DataFrame:
    """What ``listen`` left behind, for ``split_errors`` and ``error_counts``."""
    rows = spark.read.schema(_OUTCOME.format(result_type)).parquet(path)
    return rows.drop("writer", "batch_id")


def handled_counts(spark: SparkSession, path: str) -> DataFrame:
    """Messages handed over per shard, over all micro-batches and restarts."""
    stored = spark.read.schema("stream string, shard_id string, sequence_number string").parquet(path)
    return message_counts(stored)


_FILL = "stream string, shard_id string, room bigint, held bigint"


def _fill(offers: DataFrame, most: int, drained: int | Drained, path: str, writer: str, batch_id: int) -> DataFrame:
    """Room per shard when a micro-batch begins, and what the buffer holds after it.

    One row a shard that ever had offers; stored once, before the offers are marked, so a
    batch that runs again finds the same room.
    """
    spark, stored = offers.sparkSession, f"{path}-fill"

    def write(run: str) -> None:
        zero = F.lit(0).cast("long")
        parts = [offers.groupBy(*SHARD_KEYS).agg(F.count(F.lit(1)).alias("offered"), zero.alias("held"), zero.alias("gone"))]
        if batch_id > 0:
            before = spark.read.schema(_FILL).parquet(folder(stored, writer, batch_id - 1))
            gone = F.lit(drained).cast("long") if isinstance(drained, int) else zero
            parts.append(before.select(*SHARD_KEYS, zero.alias("offered"), "held", gone.alias("gone")))
            if not isinstance(drained, int):
                taken = drained(spark, batch_id).select(*SHARD_KEYS, zero.alias("offered"), zero.alias("held"), F.col("n").cast("long").alias("gone"))
                parts.append(taken)
        sums = reduce(DataFrame.unionByName, parts).groupBy(*SHARD_KEYS).agg(*(F.sum(c).alias(c) for c in ("offered", "held", "gone")))
        left = F.greatest(F.col("held") - F.col("gone"), F.lit(0))
        room = F.lit(most) - left
        fill = sums.select(*SHARD_KEYS, room.alias("room"), (left + F.least(F.col("offered"), room)).alias("held"))
        fill.write.parquet(run)

    write_once(spark, stored, f"writer={writer}/batch_id={batch_id}", write)
    if batch_id > 1:
        remove(spark, folder(stored, writer, batch_id - 2))  # nothing asks for it any more
    return spark.read.schema(_FILL).parquet(folder(stored, writer, batch_id))


def admit_stream(
    offers: DataFrame, concurrency: int, path: str, checkpoint: str, drained: int | Drained | None = None, **options
) -> StreamingQuery:
    """Bounded admission into a buffer that stays as full as it is from batch to batch.

    Each shard's buffer takes ``concurrency * 1000`` messages; of a micro-batch the first
    ones that fit are accepted, the others dropped.  ``drained`` tells what left the buffer
    since the micro-batch before: a number for every shard, or a function of the session
    and the batch that returns ``(stream, shard_id, n)``.  Without it all that was accepted
    is taken to be sent by then.  How full a buffer is stands in one row a shard, so a hot
    shard's offers are numbered by many tasks.  A batch that runs twice marks its rows once.
    ``trigger`` is that of the stream; other options are those of ``admit``.
    """
    trigger = options.pop("trigger", None) or READ_PACE
    most = capacity(concurrency)

    def save(batch: DataFrame, writer: str, batch_id: int) -> None:
        if drained is None:
            marked = admit(batch, concurrency, **options)
        else:
            batch = materialised(batch, "offers")
            marked = admit_into(batch, _fill(batch, most, drained, path, writer, batch_id), **options)
        save_once(marked, path, writer, batch_id)

    return write_batches(offers, save, checkpoint, trigger)


def admitted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("accepted")).drop("accepted", "reason", "writer", "batch_id")


def dropped(spark: SparkSession, path: str) -> DataFrame:
    """Which offers were turned away, and why."""
    turned_away = spark.read.parquet(path).where(~F.col("accepted"))
    return turned_away.select(*SHARD_KEYS, "sequence_number", "partition_key", "reason", "batch_id")
