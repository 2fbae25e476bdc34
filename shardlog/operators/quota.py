"""Audit recorded traffic against rate and size quotas.

Most are grouped counts and sums over tumbling windows: Spark combines them before the
shuffle, so a hot shard or stream sends one row per task and window.  The peaks look at
every window, wherever it begins.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlog.operators.running import SUM, running_over
from shardlog.schema import (
    DELIVERY_BYTES_PER_SECOND,
    DELIVERY_RECORDS_PER_SECOND,
    DELIVERY_REQUESTS_PER_SECOND,
    FETCHES_PER_SECOND,
    MAX_DELIVERY_CALL_BYTES,
    MAX_RECORD_BYTES,
    MAX_REQUEST_BYTES,
    MAX_REQUEST_RECORDS,
    RECORDS_PER_FETCH,
    SHARD_KEYS,
    WRITE_BYTES_PER_SECOND,
    WRITES_PER_SECOND,
)
from shardlog.workdir import materialised

SECOND = "1 second"


def put_bytes() -> Column:
    """Size of a record as the quotas count it: payload and key."""
    size = F.coalesce(F.octet_length("data"), F.lit(0))
    return (size + F.coalesce(F.octet_length("partition_key"), F.lit(0))).cast("long")


def traffic(records: DataFrame, keys: list[str], every: str = SECOND) -> DataFrame:
    """Records and bytes per key and tumbling window of arrival time."""
    return (
        records.groupBy(*keys, F.window("arrival_ts", every).alias("_w"))
        .agg(F.count(F.lit(1)).alias("n_records"), F.sum(put_bytes()).alias("n_bytes"))
        .select(*keys, F.col("_w.start").alias("window_start"), "n_records", "n_bytes")
    )


def peak_traffic(records: DataFrame, keys: list[str], period: int = 1_000_000) -> DataFrame:
    """The most records, and the most bytes, that any window of ``period`` microseconds holds.

    One row a key: ``n_records`` and ``n_bytes`` with the time at which the first such
    window ends, ``records_at`` and ``bytes_at``.  A window reaches back from its end, which
    it includes, to a period before, which it does not.  Records of one moment are combined
    before the shuffle; then each moment adds its records and, a period later, takes them
    away, and the windows are the running sums, which are spread over tasks by time as well.
    Records without an arrival time are in no window.
    """
    at = F.unix_micros("arrival_ts")
    moments = (
        records.where(F.col("arrival_ts").isNotNull())
        .groupBy(*keys, at.alias("_t"))
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(put_bytes()).alias("_b"))
        .withColumn("_kind", F.lit(1))
    )
    moments = materialised(moments, "moments")
    gone = moments.select(*keys, (F.col("_t") + period).alias("_t"), (-F.col("_n")).alias("_n"), (-F.col("_b")).alias("_b"), F.lit(0).alias("_kind"))
    held = running_over(
        moments.unionByName(gone), keys, ["_t", "_kind"], {"n_records": (SUM, F.col("_n")), "n_bytes": (SUM, F.col("_b"))}
    )
    first = lambda c: F.max(F.struct(F.col(c).alias("n"), (-F.col("_t")).alias("t"))).alias(f"_{c}")
    best = held.where("_kind = 1").groupBy(*keys).agg(first("n_records"), first("n_bytes"))
    when = lambda c: F.timestamp_micros(-F.col(f"_{c}.t"))
    return best.select(
        *keys, F.col("_n_records.n").alias("n_records"), when("n_records").alias("records_at"),
        F.col("_n_bytes.n").alias("n_bytes"), when("n_bytes").alias("bytes_at"),
    )


def write_peak(
    records: DataFrame, max_records: int = WRITES_PER_SECOND, max_bytes: int = WRITE_BYTES_PER_SECOND, period: int = 1_000_000
) -> DataFrame:
    """``peak_traffic`` of each shard, and whether any second of it, not only whole ones, exceeds a write quota."""
    over = (F.col("n_records") > max_records) | (F.col("n_bytes") > max_bytes)
    return peak_traffic(records, SHARD_KEYS, period).withColumn("exceeded", over)


def delivery_peak(
    records: DataFrame, max_records: int = DELIVERY_RECORDS_PER_SECOND, max_bytes: int = DELIVERY_BYTES_PER_SECOND, period: int = 1_000_000
) -> DataFrame:
    """The same for a keyless stream, whose keys do not count."""
    over = (F.col("n_records") > max_records) | (F.col("n_bytes") > max_bytes)
    payload = records.withColumn("partition_key", F.lit(""))
    return peak_traffic(payload, ["stream"], period).withColumn("exceeded", over)


def read_rate(
    records: DataFrame,
    per_fetch: int = RECORDS_PER_FETCH,
    limit: int = FETCHES_PER_SECOND,
    every: str = SECOND,
) -> DataFrame:
    """Windows in which one reader needs more fetches per shard than it is allowed."""
    fetches = F.ceil(F.col("n_records") / per_fetch)
    counted = traffic(records, SHARD_KEYS, every).withColumn("n_fetches", fetches)
    return counted.where(F.col("n_fetches") > limit).drop("n_bytes")


def write_rate(
    records: DataFrame, limit: int = WRITES_PER_SECOND, every: str = SECOND
) -> DataFrame:
    """Windows with more records per shard than may be written."""
    return traffic(records, SHARD_KEYS, every).where(F.col("n_records") > limit).drop("n_bytes")


def write_bytes(
    records: DataFrame, limit: int = WRITE_BYTES_PER_SECOND, every: str = SECOND
) -> DataFrame:
    """Windows with more bytes per shard, keys included, than may be written."""
    return traffic(records, SHARD_KEYS, every).where(F.col("n_bytes") > limit).drop("n_records")


def oversized_records(records: DataFrame, limit: int = MAX_RECORD_BYTES) -> DataFrame:
    return records.where(F.octet_length("data") > limit)


def oversized_requests(
    requests: DataFrame,
    max_records: int = MAX_REQUEST_RECORDS,
    max_bytes: int = MAX_REQUEST_BYTES,
) -> DataFrame:
    """Requests with too many entries or too many bytes."""
    return (
        requests.groupBy("stream", "request_id")
        .agg(F.count(F.lit(1)).alias("n_records"), F.sum(put_bytes()).alias("n_bytes"))
        .where((F.col("n_records") > max_records) | (F.col("n_bytes") > max_bytes))
    )


def oversized_calls(
    requests: DataFrame,
    max_records: int = MAX_REQUEST_RECORDS,
    max_bytes: int = MAX_DELIVERY_CALL_BYTES,
) -> DataFrame:
    """The same for keyless delivery, which sends the payload only."""
    payload = requests.withColumn("partition_key", F.lit(""))
    return oversized_requests(payload, max_records, max_bytes)


def delivery_rate(
    records: DataFrame,
    per_request: int = 1,
    max_requests: int = DELIVERY_REQUESTS_PER_SECOND,
    max_records: int = DELIVERY_RECORDS_PER_SECOND,
    max_bytes: int = DELIVERY_BYTES_PER_SECOND,
    every: str = SECOND,
) -> DataFrame:
    """Windows in which a keyless stream exceeds its request, record or byte quota.

    Keyless delivery sends the payload only, so keys do not count.
    """
    payload = records.withColumn("partition_key", F.lit(""))
    counted = traffic(payload, ["stream"], every).withColumn(
        "n_requests", F.ceil(F.col("n_records") / per_request)
    )
    return counted.where(
        (F.col("n_requests") > max_requests)
        | (F.col("n_records") > max_records)
        | (F.col("n_bytes") > max_bytes)
    )
