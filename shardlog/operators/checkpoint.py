"""Remember the last record per shard, continue from it, remove what comes twice."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardlog.functions.sequence import is_numbered, number_key
from shardlog.operators.positions import read_from_positions
from shardlog.schema import AFTER_SEQUENCE_NUMBER, AT_SEQUENCE_NUMBER, SHARD_KEYS
from shardlog.workdir import materialised


def checkpoint(records: DataFrame) -> DataFrame:
    """Last sequence number per shard; records without one are ignored."""
    return (
        records.where(is_numbered())
        .groupBy(*SHARD_KEYS)
        .agg(F.max(number_key()).alias("last"))
        .select(*SHARD_KEYS, F.col("last.number").alias("sequence_number"), F.col("last.len").alias("sequence_len"))
    )


def progress(records: DataFrame) -> DataFrame:
    """Messages read and last sequence number per shard, in one pass."""
    return (
        records.groupBy(*SHARD_KEYS)
        .agg(
            F.count(F.lit(1)).alias("n_messages"),
            F.max(F.when(is_numbered(), number_key())).alias("last"),
        )
        .select(*SHARD_KEYS, "n_messages", F.col("last.number").alias("checkpoint"))
    )


def advance(saved: DataFrame, seen: DataFrame) -> DataFrame:
    """Saved checkpoint moved forward by another one, shard by shard."""
    return checkpoint(saved.unionByName(seen))


def resume_positions(
    positions: DataFrame, saved: DataFrame, inclusive: bool = True
) -> DataFrame:
    """Start at the saved number where there is one, else at the original position.

    ``inclusive`` reads the last seen record again (at-least-once).
    """
    restart = AT_SEQUENCE_NUMBER if inclusive else AFTER_SEQUENCE_NUMBER
    last = saved.select(*SHARD_KEYS, F.col("sequence_number").alias("_last"))
    known = F.col("_last").isNotNull()
    return positions.join(last, SHARD_KEYS, "left").select(
        *SHARD_KEYS,
        F.when(known, F.lit(restart)).otherwise(F.col("position")).alias("position"),
        F.coalesce("_last", "sequence_number").alias("sequence_number"),
        F.when(~known, F.col("at_ts")).alias("at_ts"),
    )


def resume(
    records: DataFrame,
    positions: DataFrame,
    saved: DataFrame,
    inclusive: bool = True,
) -> DataFrame:
    """Read on after a stop; see ``resume_positions`` and ``read_from_positions``."""
    return read_from_positions(records, resume_positions(positions, saved, inclusive))


IDENTITY = [*SHARD_KEYS, "sequence_number"]


def drop_replays(records: DataFrame, within: str | None = None) -> DataFrame:
    """Keep one copy of every (stream, shard, sequence number).

    Records without a number pass untouched: nothing tells whether they are
    copies.  On a stream, the default remembers every number.  ``within`` bounds
    that state by arrival time, and then records later than that bound may be lost.
    """
    numbered, rest = records.where(is_numbered()), records.where(~is_numbered())
    if within is None:
        return numbered.dropDuplicates(IDENTITY).unionByName(rest)
    timed = numbered.withWatermark("arrival_ts", within)
    return timed.dropDuplicatesWithinWatermark(IDENTITY).unionByName(rest)


def drop_rare_replays(records: DataFrame) -> DataFrame:
    """``drop_replays`` for a large stored log in which few records come twice.

    ``drop_replays`` sorts and shuffles every payload.  Here only the identifying
    columns are shuffled, to find what comes twice; those few numbers are stored
    once, and where they are few enough to broadcast, all other records pass
    without a shuffle.  The log is read three times, so the input should be a
    stored table rather than a long computation.
    """
    counted = records.where(is_numbered()).groupBy(*IDENTITY).count()
    twice = materialised(counted.where(F.col("count") > 1).drop("count"), "replays")
    once = records.join(twice, IDENTITY, "left_anti")
    copies = records.join(twice, IDENTITY, "left_semi")
    return once.unionByName(copies.dropDuplicates(IDENTITY))
