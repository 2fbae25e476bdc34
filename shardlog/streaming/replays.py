"""Append to a log what it does not hold yet: the log itself is the memory."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shardlog.functions.sequence import is_numbered, number_key
from shardlog.operators.checkpoint import IDENTITY
from shardlog.schema import SHARD_GROUP, SHARD_KEYS
from shardlog.sources.files import exists
from shardlog.sources.log import scan, scan_groups, with_group, write_part
from shardlog.streaming.writers import write_batches
from shardlog.workdir import materialised


def held(spark: SparkSession, path: str, ranges: DataFrame) -> DataFrame:
    """Numbers that the log at ``path`` holds in ``ranges (stream, shard_id, n, least, greatest)``.

    The least and the greatest number of all ranges are literals, which reach the Parquet
    filters; the join with the ranges prunes the log to the folders of their shards when the
    query runs, and then to each shard's own range.
    """
    ends = ranges.agg(F.min("least").alias("least"), F.max("greatest").alias("greatest")).first()  # two numbers
    if ends["least"] is None:
        return scan(spark, path).select(*IDENTITY).where(F.lit(False))
    (least_len, least), (most_len, most) = ends["least"], ends["greatest"]
    length, number = F.col("sequence_len"), F.col("sequence_number")
    above = (length > least_len) | ((length == least_len) & (number >= least))
    below = (length < most_len) | ((length == most_len) & (number <= most))
    within = (number_key() >= F.col("least")) & (number_key() <= F.col("greatest"))
    known = scan_groups(spark, path).where(above & below)
    return known.join(with_group(ranges.where("n > 0")), [*SHARD_KEYS, SHARD_GROUP]).where(within).select(*IDENTITY)


def not_held(spark: SparkSession, batch: DataFrame, path: str) -> DataFrame:
    """One copy of each record of ``batch`` that the log at ``path`` does not hold; unnumbered ones as they are."""
    numbered, rest = batch.where(is_numbered()), batch.where(~is_numbered())
    once = numbered.dropDuplicates(IDENTITY)
    if exists(spark, path):
        ranges = numbered.groupBy(*SHARD_KEYS).agg(
            F.count(F.lit(1)).alias("n"), F.min(number_key()).alias("least"), F.max(number_key()).alias("greatest")
        )
        # one row a shard, stored so that Spark knows how many there are
        known = held(spark, path, materialised(ranges, "ranges")).distinct()
        once = once.join(known, IDENTITY, "left_anti")
    return once.unionByName(rest)


def append_new(
    records: DataFrame, path: str, checkpoint: str, partitions: int | None = None, **trigger
) -> StreamingQuery:
    """``streaming.append.append`` that leaves out replays, without remembering every number.

    Each micro-batch looks into the part of the log that its own numbers span: replays come
    soon after what they repeat, so that is the log's end.  The stream has no state, however
    long it runs, and a replay is found however late it comes.  What other writers have
    appended before a micro-batch began counts as well; two writers that append the same
    numbers at the same time are not told apart.  ``sequence_len`` must be set, as it is in
    every stored log.
    """

    def save(batch: DataFrame, writer: str, batch_id: int) -> None:
        spark = batch.sparkSession
        part = f"{path}/writer={writer}/batch_id={batch_id}"
        if not exists(spark, part):  # else the batch would find itself in the log
            write_part(not_held(spark, materialised(batch, "batch"), path), path, writer, batch_id, partitions)

    return write_batches(records, save, checkpoint, trigger)
