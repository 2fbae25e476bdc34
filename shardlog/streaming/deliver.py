"""Send, look at the answer, send again what was not delivered.

Every attempt is written before anything reads it, so looking at its outcome
never sends again.  A run of a micro-batch has a folder of its own, and the
batch names the run that counts only when it is complete: a run that was cut
off and started anew leaves no rows behind in the result.  Sending itself is
at-least-once.
"""

import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shardlog.schema import MAX_REQUEST_RECORDS, require_concurrency
from shardlog.sources.files import exists, remove
from shardlog.streaming.writers import folder, save_once, write_batches

# A sender gets the (partition_key, data) pairs of one request and the attempt
# number.  It returns None when there is no response, else the failed count and
# one (error_code, error_message) pair per record, in the order of the request.
Entry = tuple[str | None, str | None]
Sender = Callable[[list[tuple[str, bytes]], int], tuple[int | None, list[Entry]] | None]

ALONE = "alone"  # the writer of batches delivered one by one
DELIVERED, FAILED, UNANSWERED = "delivered", "failed", "unanswered"

_SENT = (
    "stream string, partition_key string, data binary, n_bytes bigint, "
    "outcome string, error_message string"
)
_SENT_IN = f"{_SENT}, writer string, batch_id bigint, run string, attempt int"
_COMMIT = "run string, attempts int"


def _outcomes(request: list, sender: Sender, attempt: int) -> list[tuple[str, str | None]]:
    """Send one request; outcome and error of each of its records, by position."""
    try:
        response = sender(request, attempt)
    except Exception as failure:  # no answer: all of its records go out again
        return [(UNANSWERED, str(failure) or type(failure).__name__)] * len(request)
    if response is None:
        return [(UNANSWERED, None)] * len(request)
    failed_count, entries = response
    outcomes = [(DELIVERED, None)] * len(request)
    if failed_count:
        for idx, (code, text) in enumerate(entries[: len(request)]):
            if code or text:
                outcomes[idx] = (FAILED, text or "")
    return outcomes


def _round(pending: DataFrame, sender: Sender, per_request: int) -> DataFrame:
    """Send every pending record once; a request holds records of one stream and ``attempt``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (_, attempt), rows in batch.groupby(["stream", "attempt"], sort=False, dropna=False):
                records = list(zip(rows["partition_key"], rows["data"]))
                outcomes = []
                for start in range(0, len(records), per_request):
                    request = records[start : start + per_request]
                    outcomes += _outcomes(request, sender, int(attempt))
                yield rows.assign(
                    n_bytes=[len(data or b"") for _, data in records],
                    outcome=[outcome for outcome, _ in outcomes],
                    error_message=pd.Series(
                        [error for _, error in outcomes], index=rows.index, dtype=object
                    ),
                )

    return pending.select("stream", "partition_key", "data", "attempt").mapInPandas(run, f"{_SENT}, attempt int")


def _attempt(pending: DataFrame, sender: Sender, attempt: int, per_request: int) -> DataFrame:
    return _round(pending.withColumn("attempt", F.lit(attempt)), sender, per_request).drop("attempt")


def _commit_of(spark: SparkSession, out: str, batch_id: int, writer: str = ALONE):
    path = folder(f"{out}/commits", writer, batch_id)
    return spark.read.schema(_COMMIT).parquet(path).first() if exists(spark, path) else None


def deliver_batch(
    records: DataFrame,
    batch_id: int,
    sender: Sender,
    out: str,
    max_attempts: int | None = None,
    per_request: int = MAX_REQUEST_RECORDS,
    keyless: bool = False,
    concurrency: int | None = None,
    keep_payload: bool = False,
    writer: str = ALONE,
) -> None:
    """Deliver one batch; a batch that is already complete is not sent again.

    Records are sent until they are delivered.  With ``max_attempts`` what is left
    after so many becomes dead letters, which ``resend`` takes up again.  The
    payload of delivered records is not stored, unless ``keep_payload``.  Keyless
    delivery sends records again with the empty key.
    """
    spark = records.sparkSession
    if _commit_of(spark, out, batch_id, writer) is not None:
        return
    if concurrency is not None:
        require_concurrency(concurrency)
        records = records.repartition(concurrency)
    # A request entry is payload and key; a null key is sent as the empty one.
    key = F.coalesce("partition_key", F.lit("")).alias("partition_key")
    pending = records.select("stream", key, "data")
    run = uuid.uuid4().hex
    for attempt in count(1):
        path = f"{folder(f'{out}/attempts', writer, batch_id)}/run={run}/attempt={attempt}"
        sent = _attempt(pending, sender, attempt, per_request)
        if not keep_payload:
            kept = F.when(F.col("outcome") != DELIVERED, F.col("data"))
            sent = sent.withColumn("data", kept)
        sent.write.parquet(path)
        left = spark.read.schema(_SENT).parquet(path).where(F.col("outcome") != DELIVERED)
        if attempt == max_attempts or left.isEmpty():
            break
        key = F.lit("") if keyless else F.col("partition_key")
        pending = left.select("stream", key.alias("partition_key"), "data")
    _commit(spark, out, writer, batch_id, run, attempt)


def deliver(
    records: DataFrame,
    sender: Sender,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Deliver a stream; all attempts of a micro-batch happen inside it.

    A record that is refused again and again holds up what comes behind it, so order is
    kept; ``deliver_queued`` sends it later instead.  Several streams may deliver to one ``out``.
    """

    def send(batch: DataFrame, writer: str, batch_id: int) -> None:
        deliver_batch(batch, batch_id, sender, out, writer=writer, **options)

    return write_batches(records, send, checkpoint, trigger)


_QUEUED = "stream string, partition_key string, data binary, attempt int, due bigint"


def _queue(spark: SparkSession, out: str, writer: str, batch_id: int) -> DataFrame:
    """What waits to be sent again after a micro-batch; nothing once ``drain`` has sent it."""
    path = folder(f"{out}/queue", writer, batch_id)
    if batch_id < 0 or exists(spark, folder(f"{out}/drained", writer, batch_id)):
        return spark.createDataFrame([], _QUEUED)
    return spark.read.schema(_QUEUED).parquet(path)


def deliver_queued(
    records: DataFrame,
    sender: Sender,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_attempts: int | None = None,
    per_request: int = MAX_REQUEST_RECORDS,
    keyless: bool = False,
    concurrency: int | None = None,
    wait: int = 1,
    when_idle: bool = False,
) -> StreamingQuery:
    """Deliver a stream; what is refused queues behind what is new and holds nothing up.

    A micro-batch sends its own records and those of the queue that are due, each once, and
    ends.  What was not delivered goes into the queue and is due ``wait`` micro-batches
    later, each further time after twice as long, if ``wait`` is not 1.  The queue is a table
    of its own for each micro-batch, published when it is whole and removed when the one
    after the next is there, so that it may be of any size and survives executors and
    restarts.  ``attempts`` and ``delivered`` tell what happened; records refused
    ``max_attempts`` times are ``dead_letters``.  When the stream has ended, ``queued`` is
    what still waits, and ``drain`` sends it.  Without new records there is no micro-batch;
    with ``when_idle`` a clock beside the stream makes one every second, for the queue alone.
    """
    if concurrency is not None:
        require_concurrency(concurrency)
    records = records.select("stream", "partition_key", "data", F.lit(False).alias("_tick"))
    if when_idle:
        clock = records.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
        nothing = [F.lit(None).cast(records.schema[c].dataType).alias(c) for c in ("stream", "partition_key", "data")]
        records = records.unionByName(clock.select(*nothing, F.lit(True).alias("_tick")))

    def send(batch: DataFrame, writer: str, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _queue(spark, out, writer, batch_id - 1)
        key = F.coalesce("partition_key", F.lit("")).alias("partition_key")
        fresh = batch.where(~F.col("_tick")).select("stream", key, "data", F.lit(1).alias("attempt"))
        pending = fresh.unionByName(before.where(F.col("due") <= batch_id).drop("due"))
        if concurrency is not None:
            pending = pending.repartition(concurrency)
        _send_round(pending, sender, per_request, out, writer, batch_id, max_attempts)
        refused = _refused(_attempts_of(spark, out, writer, batch_id), max_attempts, keyless)
        pause = F.lit(1) if wait == 1 else (F.lit(wait) * F.pow(F.lit(2), F.least(F.col("attempt") - 2, F.lit(30)))).cast("long")
        queue = refused.withColumn("due", batch_id + pause.cast("long")).unionByName(before.where(F.col("due") > batch_id))
        save_once(queue, f"{out}/queue", writer, batch_id)
        if batch_id > 1:
            remove(spark, folder(f"{out}/queue", writer, batch_id - 2))

    return write_batches(records, send, checkpoint, trigger)


def _send_round(
    pending: DataFrame, sender: Sender, per_request: int, out: str, writer: str, batch_id: int, max_attempts: int | None
) -> None:
    """Send every pending record once, unless a run of this batch has done so."""
    spark = pending.sparkSession
    if _commit_of(spark, out, batch_id, writer) is not None:
        return
    run = uuid.uuid4().hex
    sent = _round(pending, sender, per_request)
    kept = F.when(F.col("outcome") != DELIVERED, F.col("data"))
    path = f"{folder(f'{out}/attempts', writer, batch_id)}/run={run}"
    sent.withColumn("data", kept).write.partitionBy("attempt").parquet(path)
    _commit(spark, out, writer, batch_id, run, max_attempts or 0)


def _attempts_of(spark: SparkSession, out: str, writer: str, batch_id: int) -> DataFrame:
    run = _commit_of(spark, out, batch_id, writer)["run"]
    return spark.read.schema(f"{_SENT}, attempt int").parquet(f"{folder(f'{out}/attempts', writer, batch_id)}/run={run}")


def _refused(sent: DataFrame, max_attempts: int | None, keyless: bool) -> DataFrame:
    """What of a round is to be sent once more, with the number that this attempt will have."""
    again = F.col("outcome") != DELIVERED
    if max_attempts is not None:
        again &= F.col("attempt") < max_attempts
    key = F.lit("") if keyless else F.col("partition_key")
    return sent.where(again).select("stream", key.alias("partition_key"), "data", (F.col("attempt") + 1).alias("attempt"))


def _commit(spark: SparkSession, out: str, writer: str, batch_id: int, run: str, attempts: int) -> None:
    commit = spark.range(1).select(F.lit(run).alias("run"), F.lit(attempts).alias("attempts"))
    save_once(commit.coalesce(1), f"{out}/commits", writer, batch_id)


def _last_queues(spark: SparkSession, out: str) -> list[tuple[str, int]]:
    """For each writer its last micro-batch that left a queue, unless that is drained."""
    if not exists(spark, f"{out}/queue"):
        return []
    # the newest folders only: a writer keeps two
    last = spark.read.schema("writer string, batch_id bigint").parquet(f"{out}/commits").groupBy("writer").agg(F.max("batch_id").alias("b"))
    return [(r.writer, r.b) for r in last.collect() if exists(spark, folder(f"{out}/queue", r.writer, r.b))]


def queued(spark: SparkSession, out: str) -> DataFrame:
    """What waits to be sent again, with the number of the next attempt."""
    waiting = [_queue(spark, out, writer, batch_id) for writer, batch_id in _last_queues(spark, out)]
    return reduce(DataFrame.unionByName, waiting, spark.createDataFrame([], _QUEUED)).drop("due")


def drain(
    spark: SparkSession, out: str, sender: Sender, max_attempts: int | None = None, per_request: int = MAX_REQUEST_RECORDS, keyless: bool = False
) -> None:
    """Send what waits until it is delivered, when the streams that deliver to ``out`` have ended.

    A stream that starts again finds its queue empty.  Each turn is kept as a batch of its
    own, so a drain that was cut off goes on with the turn it was in.
    """
    for writer, batch_id in _last_queues(spark, out):
        pending = _queue(spark, out, writer, batch_id).drop("due")
        for turn in count():
            if pending.isEmpty():
                break
            name = f"{writer}-drain-{turn}"
            _send_round(pending, sender, per_request, out, name, batch_id, max_attempts)
            pending = _refused(_attempts_of(spark, out, name, batch_id), max_attempts, keyless)
        save_once(spark.createDataFrame([], _QUEUED), f"{out}/drained", writer, batch_id)


def resend(spark: SparkSession, out: str, sender: Sender, again: str, **options) -> None:
    """Send the dead letters of ``out`` again; what becomes of them is kept at ``again``."""
    deliver_batch(dead_letters(spark, out), 0, sender, again, **options)


def attempts(spark: SparkSession, out: str) -> DataFrame:
    """Every send of every complete batch, with its outcome.

    ``answered`` and ``failed`` are there for ``delivery_counts``.
    """
    sent = spark.read.schema(_SENT_IN).parquet(f"{out}/attempts")
    commits = spark.read.schema(f"{_COMMIT}, writer string, batch_id bigint").parquet(f"{out}/commits")
    return (
        sent.join(commits, ["writer", "batch_id", "run"])
        .withColumn("answered", F.col("outcome") != UNANSWERED)
        .withColumn("failed", F.col("outcome") == FAILED)
    )


def delivered(spark: SparkSession, out: str) -> DataFrame:
    return attempts(spark, out).where(F.col("outcome") == DELIVERED)


def dead_letters(spark: SparkSession, out: str) -> DataFrame:
    """Records still not delivered after the last attempt of their batch."""
    last = F.col("attempt") == F.col("attempts")
    return attempts(spark, out).where(last & (F.col("outcome") != DELIVERED))
