"""When records can be sent, or fetched, if no second may see more than so many.

With at most ``limit`` sends in any period, a record goes out when it has arrived and the
one ``limit`` places before it has been gone for a period: d[i] = max(a[i], d[i - limit] +
period).  Records whose numbers leave the same rest by ``limit`` thus form a chain of their
own, in which d[i] - floor(i / limit) * period is a running maximum.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlog.operators.fetch import fetch_batches
from shardlog.operators.numbering import Numbering
from shardlog.operators.running import MAX, SUM, running, running_over
from shardlog.schema import FETCHES_PER_SECOND, RECORDS_PER_FETCH, SEQUENCE_ORDER, SHARD_KEYS, WRITES_PER_SECOND

SECOND = 1_000_000  # microseconds


def _paced(rows: DataFrame, order_by: list[str], limit: int, period: int) -> DataFrame:
    """``rows``, which have ``_at`` in microseconds, with ``_sent``; ``_at`` must not decrease within a shard."""
    if limit < 1 or period < 1:
        raise ValueError("a limit and a period must be greater than zero")
    numbered = Numbering(rows, SHARD_KEYS, order_by).rows("_row", placed=True)
    turn = F.floor(F.col("_row") / limit).cast("long") * F.lit(period)
    chains = numbered.withColumns({"_chain": F.col("_row") % limit, "_turn": turn})
    sent = running(chains, [*SHARD_KEYS, "_chain"], {"_free": (MAX, F.col("_at") - F.col("_turn"))})
    return sent.withColumn("_sent", F.col("_free") + F.col("_turn")).drop("_free", "_turn", "_chain", "_row", "_id", "_part")


def write_schedule(
    records: DataFrame, limit: int = WRITES_PER_SECOND, period: int = SECOND, order_by: list[str] | None = None
) -> DataFrame:
    """``records`` with ``send_ts``: when each is sent, first come first served, within the write quota of its shard.

    No window of ``period`` microseconds, wherever it begins, holds more than ``limit``
    sends of a shard, and no record could go earlier.  Records that arrive together are
    sent in the order of their numbers (or ``order_by``).  Records without an arrival time
    are not sent: their ``send_ts`` is null.
    """
    timed = records.where(F.col("arrival_ts").isNotNull()).withColumn("_at", F.unix_micros("arrival_ts"))
    sent = _paced(timed, ["_at", *(order_by or SEQUENCE_ORDER)], limit, period)
    made = sent.select(*records.columns, F.timestamp_micros("_sent").alias("send_ts"))
    untimed = records.where(F.col("arrival_ts").isNull()).withColumn("send_ts", F.lit(None).cast("timestamp"))
    return made.unionByName(untimed)


def with_backlog(scheduled: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """``write_schedule`` with ``waiting``: the records of the shard before each that are not sent yet when it arrives.

    A running sum over arrivals and sends of those that have to wait; a send comes before
    what arrives at that very moment.
    """
    order = order_by or SEQUENCE_ORDER
    waits = F.coalesce(F.col("send_ts") > F.col("arrival_ts"), F.lit(False))
    timed = scheduled.where(F.col("arrival_ts").isNotNull())
    arrivals = timed.select("*", F.col("arrival_ts").alias("_t"), F.lit(1).alias("_kind"), F.when(waits, 1).otherwise(0).alias("_more"))
    sends = timed.where(waits).select(*SHARD_KEYS, F.col("send_ts").alias("_t"), F.lit(0).alias("_kind"), F.lit(-1).alias("_more"))
    moments = arrivals.unionByName(sends, allowMissingColumns=True)
    summed = running_over(moments, SHARD_KEYS, ["_t", "_kind", *order], {"_sum": (SUM, F.col("_more"))})
    waiting: Column = (F.col("_sum") - F.col("_more")).cast("long").alias("waiting")
    untimed = scheduled.where(F.col("arrival_ts").isNull()).withColumn("waiting", F.lit(None).cast("long"))
    return summed.where("_kind = 1").select(*scheduled.columns, waiting).unionByName(untimed)


def read_schedule(
    records: DataFrame, per_fetch: int = RECORDS_PER_FETCH, limit: int = FETCHES_PER_SECOND, period: int = SECOND
) -> DataFrame:
    """One row a shard and fetch: ``fetch_no``, ``n_records``, ``ready_ts`` and ``fetch_ts``.

    A fetch is ready when the last of its records has arrived, and not before the one before
    it; ``fetch_ts`` is when one reader that keeps its quota makes it.
    """
    fetches = fetch_batches(records, per_fetch).groupBy(*SHARD_KEYS, "fetch_no").agg(
        F.count(F.lit(1)).alias("n_records"), F.max(F.unix_micros("arrival_ts")).alias("_last")
    )
    ready = running_over(fetches, SHARD_KEYS, ["fetch_no"], {"_at": (MAX, F.col("_last"))}).where(F.col("_at").isNotNull())
    made = _paced(ready, ["fetch_no"], limit, period)
    times = F.timestamp_micros("_at").alias("ready_ts"), F.timestamp_micros("_sent").alias("fetch_ts")
    return made.select(*SHARD_KEYS, "fetch_no", "n_records", *times)
