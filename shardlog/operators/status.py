"""Only streams whose status is ACTIVE may be used."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardlog.operators.lookup import lookup
from shardlog.operators.running import LAST, running_over
from shardlog.schema import ACTIVE, ERR_NIL_STATUS, ERR_NOT_ACTIVE, ERR_UNKNOWN_STREAM


def active_only(records: DataFrame, streams: DataFrame) -> DataFrame:
    """Records of active streams; a stream without a known status is not active."""
    active = streams.where(F.col("status") == ACTIVE).select("stream").distinct()
    return lookup(records, active, ["stream"], how="left_semi")


def rejected_streams(streams: DataFrame) -> DataFrame:
    """Listed streams that may not be used, and why."""
    return streams.where(~F.col("status").eqNullSafe(ACTIVE)).select(
        "stream",
        F.when(F.col("status").isNull(), F.lit(ERR_NIL_STATUS))
        .otherwise(F.lit(ERR_NOT_ACTIVE))
        .alias("reason"),
    )


def rejected(records: DataFrame, streams: DataFrame) -> DataFrame:
    """All records that ``active_only`` leaves out, each with the ``reason``.

    Streams that are not listed are refused too.
    """
    listed = streams.groupBy("stream").agg(
        F.bool_or(F.col("status").eqNullSafe(ACTIVE)).alias("_active"),
        F.count("status").alias("_statuses"),
    )
    reason = (
        F.when(F.col("_statuses").isNull(), F.lit(ERR_UNKNOWN_STREAM))
        .when(F.col("_statuses") == 0, F.lit(ERR_NIL_STATUS))
        .otherwise(F.lit(ERR_NOT_ACTIVE))
    )
    known = lookup(records, listed, ["stream"], how="left")
    refused = known.where(~F.coalesce("_active", F.lit(False)))
    return refused.select(*records.columns, reason.alias("reason"))


def status_at_arrival(records: DataFrame, history: DataFrame) -> DataFrame:
    """``records`` with ``status``, the one their stream had when they arrived, and ``known``, whether it had any.

    ``history`` has ``(stream, status, at)``: from ``at`` on, the stream has that status,
    which may be null; of statuses of one moment the greatest by name counts, a null the
    least.  Records without an arrival time meet no status.  Statuses and records are
    sorted together by stream and time, and the last status is carried on over partition
    borders, so a stream that holds most of the records is spread over tasks.
    """
    changes = history.select(
        "stream", F.col("at").alias("_t"), F.lit(0).alias("_kind"), F.col("status").alias("_name"), F.struct("status").alias("_status")
    )
    moments = records.withColumns({"_t": F.col("arrival_ts"), "_kind": F.lit(1)}).unionByName(
        changes.where(F.col("_t").isNotNull()), allowMissingColumns=True
    )
    # a null time would be before all others; there is no status yet
    known = running_over(moments, ["stream"], ["_t", "_kind", "_name"], {"_last": (LAST, F.col("_status"))})
    return known.where("_kind = 1").select(*records.columns, F.col("_last.status").alias("status"), F.col("_last").isNotNull().alias("known"))


def active_at_arrival(records: DataFrame, history: DataFrame) -> DataFrame:
    """Records whose stream was active when they arrived."""
    return status_at_arrival(records, history).where(F.col("status") == ACTIVE).select(*records.columns)


def rejected_at_arrival(records: DataFrame, history: DataFrame) -> DataFrame:
    """All other records, each with the ``reason``."""
    reason = (
        F.when(~F.col("known"), F.lit(ERR_UNKNOWN_STREAM))
        .when(F.col("status").isNull(), F.lit(ERR_NIL_STATUS))
        .otherwise(F.lit(ERR_NOT_ACTIVE))
    )
    refused = status_at_arrival(records, history).where(~F.col("status").eqNullSafe(ACTIVE))
    return refused.select(*records.columns, reason.alias("reason"))
