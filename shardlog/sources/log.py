"""The stored log: a Parquet table partitioned by stream and group of shards.

A stream's shards are dealt out to a fixed number of folders by a checksum of their names,
and files are sorted by shard and sequence number. So a batch makes at most one file for
each of its tasks and one for each folder, however many shards there are; few shards have
a folder each.
"""

import uuid
import zlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlog.functions.message import append_terminator, value_text
from shardlog.schema import RECORD, SEQUENCE_ORDER, SHARD_GROUP, SHARD_GROUPS, require_stream
from shardlog.sources.files import write_once

_STORED = T.StructType([*RECORD.fields, T.StructField(SHARD_GROUP, T.IntegerType())])


def shard_group(shard_id: str | Column = "shard_id") -> Column:
    """The folder of a shard."""
    return (F.crc32(shard_id) % SHARD_GROUPS).cast("int")


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All records of all shards in a stored log, whoever wrote them."""
    return scan_groups(spark, path).drop(SHARD_GROUP)


def scan_groups(spark: SparkSession, path: str) -> DataFrame:
    """The same with each record's folder: joins and filters on it, too, leave out other folders."""
    return spark.read.schema(_STORED).parquet(path).select(*RECORD.names, SHARD_GROUP)


def with_group(shards: DataFrame) -> DataFrame:
    """Rows about shards, to be joined with ``scan_groups`` by ``SHARD_KEYS`` and ``SHARD_GROUP``."""
    return shards.withColumn(SHARD_GROUP, shard_group())


def scan_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """The same log read continuously; the limits bound one micro-batch."""
    reader = spark.readStream.schema(RECORD)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path).select(*RECORD.names)


def select_shards(
    records: DataFrame, stream: str, shards: Iterable[str] | None = None
) -> DataFrame:
    """Records of one stream, optionally of some shards; of ``scan_groups`` only their folders are read."""
    require_stream(stream)
    chosen = records.where(F.col("stream") == stream)
    if shards is not None:
        names = list(shards)
        chosen = chosen.where(F.col("shard_id").isin(names))
        if SHARD_GROUP in records.columns:
            chosen = chosen.where(F.col(SHARD_GROUP).isin([zlib.crc32(s.encode()) % SHARD_GROUPS for s in names]))
    return chosen


def in_shard_order(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range-partition by folder, shard and sequence number, sorted inside each partition.

    The range boundaries fall inside large shards too, so one hot shard is spread
    over many consecutive partitions instead of landing in one.  Copies of one
    record are told apart by the input partition they come from, so that a record
    that was sent again and again is spread as well.
    """
    return _ordered(records, partitions).drop(SHARD_GROUP)


def _ordered(records: DataFrame, partitions: int | None) -> DataFrame:
    order = ["stream", SHARD_GROUP, "shard_id", *SEQUENCE_ORDER]
    told_apart = with_group(records).withColumn("_from", F.spark_partition_id())
    ranged = (
        told_apart.repartitionByRange(partitions, *order, "_from")
        if partitions
        else told_apart.repartitionByRange(*order, "_from")
    )
    return ranged.sortWithinPartitions(*order).drop("_from")


def write_part(
    records: DataFrame, path: str, writer: str, batch_id: int, partitions: int | None = None
) -> None:
    """Write one batch of one writer, which readers see whole or not at all.

    The same batch again changes nothing: its first complete run counts.
    """

    def write(run: str) -> None:
        _ordered(records, partitions).write.partitionBy("stream", SHARD_GROUP).parquet(run)

    write_once(records.sparkSession, path, f"writer={writer}/batch_id={batch_id}", write)


def append_sync(
    records: DataFrame, path: str, partitions: int | None = None, writer: str | None = None, batch_id: int = 0
) -> None:
    """Append a batch to the log and wait until it is durable.

    Sorting by shard and sequence number gives few files and tight
    min/max statistics, which is what start positions are pruned with.  Any number
    of writers may append to one log.  A batch that may have to be written again
    needs its own ``writer`` and ``batch_id``; without them it is a new one.  Readers,
    also those that follow the log, get each batch once and whole, however often it
    is started (see ``sources.files.write_once``).
    """
    write_part(records, path, writer or uuid.uuid4().hex, batch_id, partitions)


def deliver_payload(records: DataFrame, terminator: bytes = b"") -> DataFrame:
    """Keyless delivery: only the payload, with the terminator appended."""
    return records.select(append_terminator(F.col("data"), terminator).alias("data"))


def payload_lines(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Payloads as text, and those that are not UTF-8, as they are."""
    valid = F.is_valid_utf8(F.col("data").cast("string"))
    return (
        records.where(valid).select(value_text().alias("value")),
        records.where(~valid).select("data"),
    )


def write_payload(
    records: DataFrame, path: str, line_sep: str | None = None, terminator: bytes = b""
) -> None:
    """Write payloads: as text lines when a separator is given, else as Parquet bytes.

    Bytes are kept as they are, followed by the terminator.  Payloads that are not
    text cannot stand in lines; they go, as bytes, to ``path`` + ``-undecodable``.
    """
    if line_sep:
        text, odd = payload_lines(records)
        text.write.mode("append").option("lineSep", line_sep).text(path)
        if not odd.isEmpty():
            odd.write.mode("append").parquet(f"{path}-undecodable")
    else:
        deliver_payload(records, terminator).write.mode("append").parquet(path)
