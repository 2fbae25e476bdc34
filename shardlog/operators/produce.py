"""Bounded admission and the shape of put requests."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardlog.operators.numbering import Numbering, number_rows
from shardlog.schema import (
    BUFFER_PER_WORKER,
    ERR_DROPPED,
    MAX_REQUEST_RECORDS,
    SEQUENCE_ORDER,
    SHARD_KEYS,
    require_concurrency,
)


def admit(
    offers: DataFrame, concurrency: int, order_by: list[str] | None = None
) -> DataFrame:
    """Keep the first ``concurrency * 1000`` offers per shard, mark the rest as dropped.

    No row is removed: ``accepted`` tells the two apart and ``reason`` says why
    not.  Of equal offers at the edge as many are kept as fit.  A buffer that is
    partly full takes what ``admit_into`` says; see ``streaming.listen.admit_stream``.
    """
    numbered = number_rows(offers, SHARD_KEYS, order_by or SEQUENCE_ORDER, "_row")
    return _marked(numbered, offers.columns, F.lit(capacity(concurrency)))


def capacity(concurrency: int) -> int:
    require_concurrency(concurrency)
    return concurrency * BUFFER_PER_WORKER


def admit_into(offers: DataFrame, room: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """``admit`` where each shard has its own ``room`` left, one row a shard that has offers."""
    numbering = Numbering(offers, SHARD_KEYS, order_by or SEQUENCE_ORDER)
    numbered = numbering.rows("_row", room.select(*SHARD_KEYS, F.col("room").alias("_room")))
    return _marked(numbered, offers.columns, F.col("_room"))


def _marked(numbered: DataFrame, columns: list[str], room: Column) -> DataFrame:
    accepted = F.col("_row") < room
    return numbered.select(
        *columns,
        accepted.alias("accepted"),
        F.when(~accepted, F.lit(ERR_DROPPED)).alias("reason"),
    )


def put_shape(
    records: DataFrame,
    per_request: int = MAX_REQUEST_RECORDS,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Shape records as put requests of at most ``per_request`` entries.

    A request entry is the payload and the key (a null key is sent as the empty
    one); everything else is dropped.  Requests do not mix shards, and their ids
    are unique over all shards: each shard's ids follow those of the shards before it.
    """
    numbering = Numbering(records, SHARD_KEYS, order_by or SEQUENCE_ORDER)
    before = Window.orderBy(*SHARD_KEYS).rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard, so the ordered running sum is over a small table.
    first_ids = numbering.sizes().select(
        *SHARD_KEYS,
        F.coalesce(F.sum(F.ceil(F.col("_rows") / per_request)).over(before), F.lit(0)).alias("_first"),
    )
    return numbering.rows("_row", first_ids).select(
        "stream",
        (F.col("_first") + F.floor(F.col("_row") / per_request)).alias("request_id"),
        (F.col("_row") % per_request).cast("int").alias("idx"),
        F.coalesce("partition_key", F.lit("")).alias("partition_key"),
        "data",
    )
