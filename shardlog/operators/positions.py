"""Start positions: where reading of each shard begins."""

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlog.functions.sequence import after, at_or_after
from shardlog.schema import (
    AFTER_SEQUENCE_NUMBER,
    AT_SEQUENCE_NUMBER,
    AT_TIMESTAMP,
    LATEST,
    POSITION_CODES,
    SHARD_GROUP,
    SHARD_KEYS,
    TRIM_HORIZON,
)
from shardlog.sources.log import scan_groups, with_group
from shardlog.workdir import materialised


def from_trim_horizon(records: DataFrame) -> DataFrame:
    """Start at the oldest record: everything is read."""
    return records


def from_sequence(records: DataFrame, sequence_number: str) -> DataFrame:
    """Start at a sequence number, the record itself included."""
    return records.where(at_or_after(len(sequence_number), sequence_number))


def from_after_sequence(records: DataFrame, sequence_number: str) -> DataFrame:
    """Start behind a sequence number, the record itself excluded."""
    return records.where(after(len(sequence_number), sequence_number))


def from_timestamp(records: DataFrame, start: datetime | Column) -> DataFrame:
    """Start at an arrival time, inclusive."""
    return records.where(F.col("arrival_ts") >= start)


def from_latest(records: DataFrame, marks: DataFrame) -> DataFrame:
    """Records behind the frozen high-water marks; shards without a mark pass whole.

    A mark's shard may be any, so nothing is pushed into the scan of ``records``; of a
    stored log ``read_log_from_latest`` reads only what is behind the marks.
    """
    return read_from_positions(records, _behind(marks), keep_unlisted=True)


def _behind(marks: DataFrame) -> DataFrame:
    return marks.select(
        *SHARD_KEYS,
        F.lit(AFTER_SEQUENCE_NUMBER).alias("position"),
        "sequence_number",
        F.lit(None).cast("timestamp").alias("at_ts"),
    )


def read_log_from_latest(spark: SparkSession, path: str, marks: DataFrame) -> DataFrame:
    """``from_latest`` on a stored log: marks bound the scan of their shards, other shards are scanned whole."""
    return read_log_from_positions(spark, path, _behind(marks), keep_unlisted=True)


def resolve_latest(positions: DataFrame, marks: DataFrame) -> DataFrame:
    """Replace LATEST by the mark frozen when reading began (the start when there is none)."""
    mark = marks.select(*SHARD_KEYS, F.col("sequence_number").alias("_mark"))
    latest = F.col("position") == LATEST
    joined = positions.join(mark, SHARD_KEYS, "left")
    return joined.select(
        *SHARD_KEYS,
        F.when(latest & F.col("_mark").isNull(), F.lit(TRIM_HORIZON))
        .when(latest, F.lit(AFTER_SEQUENCE_NUMBER))
        .otherwise(F.col("position"))
        .alias("position"),
        F.when(latest, F.col("_mark")).otherwise(F.col("sequence_number")).alias("sequence_number"),
        "at_ts",
    )


def start_at(
    records: DataFrame,
    position: str | int = LATEST,
    sequence_number: str | None = None,
    start_time: datetime | Column | None = None,
    marks: DataFrame | None = None,
) -> DataFrame:
    """Read from one start position, given by name or code; a start time overrides it."""
    name = POSITION_CODES.get(position, "") if isinstance(position, int) else position
    if start_time is not None:
        return from_timestamp(records, start_time)
    if name == TRIM_HORIZON:
        return from_trim_horizon(records)
    if name == AT_SEQUENCE_NUMBER and sequence_number:
        return from_sequence(records, sequence_number)
    if name == AFTER_SEQUENCE_NUMBER and sequence_number:
        return from_after_sequence(records, sequence_number)
    if name == LATEST and marks is not None:
        return from_latest(records, marks)
    raise ValueError(f"cannot start at position {name} with what is given")


def _rule() -> Column:
    position, start, start_len = F.col("_position"), F.col("_start"), F.length("_start")
    return (
        F.when(position == TRIM_HORIZON, F.lit(True))
        .when(position == AT_SEQUENCE_NUMBER, at_or_after(start_len, start))
        .when(position == AFTER_SEQUENCE_NUMBER, after(start_len, start))
        .when(position == AT_TIMESTAMP, F.col("arrival_ts") >= F.col("_at_ts"))
    )


def _stored(positions: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The positions written once, after which looking at them costs little; checked.

    And for each kind of position that occurs, what all of its records fulfil.  The least
    start of a kind is a literal, so it reaches the Parquet filters.
    """
    side = materialised(
        positions.select(
            *SHARD_KEYS,
            F.col("position").alias("_position"),
            F.col("sequence_number").alias("_start"),
            F.col("at_ts").alias("_at_ts"),
        ),
        "positions",
    )
    numbered = F.col("_position").isin(AT_SEQUENCE_NUMBER, AFTER_SEQUENCE_NUMBER)
    usable = (
        (F.col("_position") == TRIM_HORIZON)
        | (numbered & (F.length("_start") > 0))
        | ((F.col("_position") == AT_TIMESTAMP) & F.col("_at_ts").isNotNull())
    )
    number = F.struct(F.length("_start").alias("len"), F.col("_start").alias("number"))
    per_shard = side.groupBy(*SHARD_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_and(F.coalesce(usable, F.lit(False))).alias("usable"),
        F.max("_position").alias("_position"),
        F.min(number).alias("least"),
        F.min(F.unix_micros("_at_ts")).alias("micros"),
    )
    kinds = per_shard.groupBy("_position", "usable").agg(
        F.max("n").alias("most"), F.min("least").alias("least"), F.min("micros").alias("micros")
    )
    bounds = {}
    for row in sorted(kinds.collect(), key=lambda r: r["usable"]):  # one row a kind, or two
        kind = row["_position"]
        if not row["usable"]:
            raise ValueError(f"cannot start at position {kind} with what is given")
        if row["most"] > 1:
            raise ValueError("cannot start a shard at more than one position")
        if kind == TRIM_HORIZON:
            bounds[kind] = F.lit(True)
        elif kind == AT_TIMESTAMP:
            bounds[kind] = F.col("arrival_ts") >= F.timestamp_micros(F.lit(row["micros"]))
        else:
            bounds[kind] = at_or_after(row["least"]["len"], row["least"]["number"])
    return side, bounds


def read_from_positions(
    records: DataFrame,
    positions: DataFrame,
    marks: DataFrame | None = None,
    keep_unlisted: bool = False,
) -> DataFrame:
    """Read every shard from its own start position; at most one position per shard.

    Shards that are not in ``positions`` are not read, unless ``keep_unlisted``.
    Positions are joined by shard; what all of them have in common is pushed down.
    """
    if marks is not None:
        positions = resolve_latest(positions, marks)
    side, bounds = _stored(positions)
    if keep_unlisted:
        joined = records.join(side, SHARD_KEYS, "left")
        return joined.where(F.col("_position").isNull() | _rule()).select(*records.columns)
    bound = reduce(Column.__or__, bounds.values(), F.lit(False))
    return records.where(bound).join(side, SHARD_KEYS).where(_rule()).select(*records.columns)


def read_log_from_positions(
    spark: SparkSession,
    path: str,
    positions: DataFrame,
    marks: DataFrame | None = None,
    keep_unlisted: bool = False,
) -> DataFrame:
    """``read_from_positions`` on a stored log, which is partitioned by groups of shards.

    Each kind of position has a scan of its own, so that a shard read from its
    start does not keep the bounds of the others from the Parquet filters.  The
    filter on the kind makes Spark prune the partitions to the groups of the kind's
    shards when the query runs, however many there are.  With ``keep_unlisted``, the
    shards of the log that have no position are found first, by their names alone, and
    read from their start in the same way.
    """
    if marks is not None:
        positions = resolve_latest(positions, marks)
    records, (side, bounds) = scan_groups(spark, path), _stored(positions)
    if keep_unlisted:
        unlisted = records.select(*SHARD_KEYS).distinct().join(side, SHARD_KEYS, "left_anti")
        whole = unlisted.select(
            *SHARD_KEYS, F.lit(TRIM_HORIZON).alias("_position"), F.lit(None).cast("string").alias("_start"), F.lit(None).cast("timestamp").alias("_at_ts")
        )
        side = materialised(side.unionByName(whole), "positions")
        bounds[TRIM_HORIZON] = F.lit(True)
    parts = [
        records.where(bound)
        .join(with_group(side.where(F.col("_position") == kind)), [*SHARD_KEYS, SHARD_GROUP])
        .where(_rule())
        .select(*records.columns)
        for kind, bound in sorted(bounds.items())
    ]
    return reduce(DataFrame.unionByName, parts, records.where(F.lit(False))).drop(SHARD_GROUP)
