"""Streaming twins: run until all input is read, return what they left behind."""

import json

from pyspark.sql import functions as F

from shardlog.operators.checkpoint import drop_replays
from shardlog.operators.consume import error_counts, split_errors
from shardlog.operators.delivery import delivery_errors
from shardlog.plans import tables
from shardlog.plans.delivery import HOUR
from shardlog.plans.delivery import ORACLES as DELIVERY_SQL
from shardlog.plans.reading import (
    CUT,
    LATEST_SQL,
    REC,
    SHOWN,
    before,
    parse_k_or_fail,
    replayed,
    shown,
)
from shardlog.plans.reading import ORACLES as READING_SQL
from shardlog.sources import log
from shardlog.sources.files import exists, publish, remove
from shardlog.streaming import append as sinks
from shardlog.streaming import deliver, latest, listen, rates
from shardlog.streaming.progress import MessageProgress
from shardlog.streaming.replays import append_new
from shardlog.streaming.writers import AT_ONCE
from shardlog.workdir import materialised, work_dir

DONE = {"availableNow": True}
KEYS = ["stream", "shard_id", "sequence_number"]


def stream_append(spark, sf):
    """Start without waiting, then wait for the end of the input."""
    base = work_dir(spark, "append")
    query = sinks.append(tables.event_stream(spark, sf), f"{base}/log", f"{base}/ck", **DONE)
    query.awaitTermination()
    return shown(log.scan(spark, f"{base}/log"))


def stream_append_two_writers(spark, sf):
    """Two streams and one batch append to one log; every event is there once."""
    base = work_dir(spark, "writers")
    events = tables.event_stream(spark, sf)
    third = F.col("sequence_number").cast("long") % 3
    for part in (0, 1):
        sinks.append_sync(events.where(third == part), f"{base}/log", f"{base}/ck-{part}")
    log.append_sync(tables.event_records(spark, sf).where(third == 2), f"{base}/log")
    return shown(log.scan(spark, f"{base}/log"))


def stream_scan(spark, sf):
    """Read a stored log in several micro-batches and append it to another one."""
    base = work_dir(spark, "scan")
    log.append_sync(tables.event_records(spark, sf), f"{base}/source")
    records = log.scan_stream(spark, f"{base}/source", max_files=3)
    sinks.append_sync(records, f"{base}/log", f"{base}/ck")
    return shown(log.scan(spark, f"{base}/log"))


def stream_latest(spark, sf):
    """Marks are frozen on what is stored at the cut; the stream brings the whole log."""
    base = work_dir(spark, "latest")
    stored = before(tables.event_records(spark, sf), CUT)
    records = latest.read_latest(tables.event_stream(spark, sf), stored, f"{base}/marks")
    sinks.append_sync(records, f"{base}/log", f"{base}/ck")
    return shown(log.scan(spark, f"{base}/log"))


def stream_resume(spark, sf):
    """Stop, let more arrive, start again from the same checkpoint."""
    base = work_dir(spark, "resume")
    records = tables.event_records(spark, sf)
    early = F.col("arrival_ts") < F.lit(CUT).cast("timestamp")
    for part in (records.where(early), records.where(~early)):
        log.append_sync(part, f"{base}/source")
        stream = log.scan_stream(spark, f"{base}/source")
        sinks.append_sync(stream, f"{base}/log", f"{base}/ck")
    return shown(log.scan(spark, f"{base}/log"))


def stream_drop_replays(spark, sf):
    base = work_dir(spark, "replays")
    delivered = replayed(tables.event_records(spark, sf), spark)
    log.append_sync(delivered, f"{base}/source")
    records = drop_replays(log.scan_stream(spark, f"{base}/source", max_files=6))
    sinks.append_sync(records, f"{base}/log", f"{base}/ck")
    return shown(log.scan(spark, f"{base}/log"))


def stream_append_new(spark, sf):
    """Replays that come micro-batches later are looked for in the log that was written before."""
    base = work_dir(spark, "append-new")
    delivered = replayed(tables.event_records(spark, sf), spark)
    log.append_sync(delivered, f"{base}/source")
    records = log.scan_stream(spark, f"{base}/source", max_files=3)
    append_new(records, f"{base}/log", f"{base}/ck", **DONE).awaitTermination()
    return shown(log.scan(spark, f"{base}/log"))


def stream_progress(spark, sf):
    """The total that a listener has counted over two runs of a stream, and its progress lines."""
    base = work_dir(spark, "progress")
    lines = []
    for turn in range(2):  # in the second run as much again
        with MessageProgress(spark, f"{base}/ck", every=100, tell=lines.append) as seen:

            def start(records):
                return listen.listen(seen.counted(records), parse_k_or_fail, "bigint", f"{base}/out", f"{base}/ck", **AT_ONCE)

            _in_parts(spark, sf, f"{base}/source", start, turn)
    return spark.createDataFrame([(seen.total, len(lines))], "n_messages long, n_lines long")


def refuse_by_k(request, attempt):
    """A sender: some records are never taken, some only at the third attempt."""
    entries = []
    for _, data in request:
        k = json.loads(data)["k"]
        refused = k % 10 == 0 or (k % 10 == 1 and attempt < 3)
        entries.append(("Throttled", f"not now: {k}") if refused else (None, None))
    return sum(code is not None for code, _ in entries), entries


def stream_deliver(spark, sf):
    base = work_dir(spark, "deliver")
    deliver.deliver(
        tables.event_stream(spark, sf),
        refuse_by_k,
        f"{base}/out",
        f"{base}/ck",
        trigger=DONE,
        max_attempts=3,
    ).awaitTermination()
    sent = deliver.attempts(spark, f"{base}/out")
    return sent.select(
        "stream", "partition_key", "n_bytes", "attempt", "outcome", "error_message"
    )


def break_off_by_k(request, attempt):
    """A sender that breaks off at some first attempts and gives no answer at some second ones."""
    k = json.loads(request[0][1])["k"]
    if attempt == 1 and k == 7:
        raise ConnectionError("reset by peer")
    if k == 7 and attempt == 2:
        return None
    return 0, [(None, None)] * len(request)


def stream_deliver_two_writers(spark, sf):
    """Two streams deliver into one place until all is delivered, in requests of one record."""
    base = work_dir(spark, "deliver-all")
    events = tables.event_stream(spark, sf)
    for part in (0, 1):
        deliver.deliver(
            events.where(F.col("sequence_number").cast("long") % 2 == part),
            break_off_by_k,
            f"{base}/out",
            f"{base}/ck-{part}",
            trigger=DONE,
            per_request=1,
        ).awaitTermination()
    sent = deliver.attempts(spark, f"{base}/out")
    errors = error_counts(delivery_errors(sent)).select("stream", "error_message", "n_errors")
    done = deliver.delivered(spark, f"{base}/out").groupBy("stream").agg(F.count(F.lit(1)).alias("n_errors"))
    return errors.unionByName(done.withColumn("error_message", F.lit("none: delivered")))


PARTS = 8  # micro-batches that the queries on carried state make of the events


def _in_parts(spark, sf, path, start, turn=0):
    """Lets a stream that ``start`` begins on its records read the events in ``PARTS`` micro-batches.

    All parts are written at once, by as many tasks as read the events. They are shown to the
    stream one after the other, each whole, when the one before has been read.
    """
    records = tables.event_records(spark, sf)
    staged = work_dir(spark, "parts")
    part_of = F.col("sequence_number").cast("long") % PARTS
    records.withColumn("part", part_of).write.partitionBy("part").parquet(staged)
    query = None
    try:
        for part in range(PARTS):
            run = f"{staged}/part={part}"
            if not exists(spark, run):  # no event belongs here; its micro-batch is empty
                records.where(F.lit(False)).write.parquet(run)
            publish(spark, run, f"{path}/turn={turn}/part={part}")
            query = query or start(log.scan_stream(spark, path))
            query.processAllAvailable()
    finally:
        if query is not None:
            query.stop()
        remove(spark, staged)


def refuse_five_times(request, attempt):
    """A sender: a tenth of the records is refused five times."""
    entries = []
    for _, data in request:
        refused = json.loads(data)["k"] % 10 == 0 and attempt <= 5
        entries.append(("Throttled", "busy") if refused else (None, None))
    return sum(code is not None for code, _ in entries), entries


def stream_deliver_queue(spark, sf):
    """What is refused waits behind newer records, which are delivered in their own micro-batch.

    After the last micro-batch the queue is drained.
    """
    base = work_dir(spark, "queue")
    out = f"{base}/out"
    _in_parts(spark, sf, f"{base}/source", lambda records: deliver.deliver_queued(records, refuse_five_times, out, f"{base}/ck", trigger=AT_ONCE))
    waiting = deliver.queued(spark, out).groupBy("stream").agg(F.count(F.lit(1)).alias("n"))
    left = materialised(waiting.select("stream", F.lit(PARTS - 1).cast("long").alias("batch_id"), F.lit(None).cast("int").alias("attempt"),
                        F.lit("waiting").alias("outcome"), "n"), "waiting")
    deliver.drain(spark, out, refuse_five_times)
    sent = deliver.attempts(spark, out).groupBy("stream", "batch_id", "attempt", "outcome").agg(F.count(F.lit(1)).alias("n"))
    return sent.unionByName(left)


def stream_admit_drained(spark, sf):
    """A buffer of 1,000 messages a shard, from which 100 are taken between micro-batches."""
    base = work_dir(spark, "admit-drained")
    out, ck = f"{base}/out", f"{base}/ck"
    _in_parts(spark, sf, f"{base}/source", lambda records: listen.admit_stream(records, 1, out, ck, drained=100, trigger=AT_ONCE))
    kept = listen.admitted(spark, f"{base}/out").select(*KEYS, F.lit(None).alias("reason"))
    gone = listen.dropped(spark, f"{base}/out").select(*KEYS, "reason")
    return kept.unionByName(gone).withColumn("accepted", F.col("reason").isNull())


def stream_scan_after_rerun(spark, sf):
    """A stream follows a log in which one batch is written again and another is cut off half-way."""
    base = work_dir(spark, "rerun")
    records = tables.event_records(spark, sf)
    even = F.col("sequence_number").cast("long") % 2 == 0
    first, second = records.where(even), records.where(~even)

    def write(batch_id, rows):
        log.append_sync(rows, f"{base}/source", writer="w", batch_id=batch_id)

    write(0, first)
    query = sinks.append(log.scan_stream(spark, f"{base}/source"), f"{base}/log", f"{base}/ck")
    query.processAllAvailable()
    write(0, first)
    broken = F.when(F.col("sequence_number").endswith("99"), F.raise_error(F.lit("cut off")).cast("binary"))
    try:
        write(1, second.withColumn("data", F.coalesce(broken, "data")))
    except Exception as error:  # the run ends here; whatever it has written does not count
        if "cut off" not in str(error):
            raise
    query.processAllAvailable()
    write(1, second)
    write(1, second)
    query.processAllAvailable()
    query.stop()
    return shown(log.scan(spark, f"{base}/log"))


def stream_message_counts(spark, sf):
    """Counts over more than a hundred micro-batches, one file in each."""
    base = work_dir(spark, "counts")
    log.append_sync(tables.event_records(spark, sf), f"{base}/source", partitions=110)
    records = log.scan_stream(spark, f"{base}/source", max_files=1)
    listen.listen(records, parse_k_or_fail, "bigint", f"{base}/out", f"{base}/ck", **DONE).awaitTermination()
    return listen.handled_counts(spark, f"{base}/out")


def stream_listen(spark, sf):
    base = work_dir(spark, "listen")
    records = tables.event_stream(spark, sf)
    listen.listen(
        records, parse_k_or_fail, "bigint", f"{base}/out", f"{base}/ck", **DONE
    ).awaitTermination()
    good, errors = split_errors(listen.outcomes(spark, f"{base}/out", "bigint"))
    return good.unionByName(errors, allowMissingColumns=True)


def stream_admit(spark, sf):
    """All offers are there at the start, so they make one micro-batch."""
    base = work_dir(spark, "admit-stream")
    offers = tables.event_stream(spark, sf)
    listen.admit_stream(offers, 2, f"{base}/out", f"{base}/ck", trigger=DONE).awaitTermination()
    kept = listen.admitted(spark, f"{base}/out").select(*KEYS, F.lit(None).alias("reason"))
    gone = listen.dropped(spark, f"{base}/out").select(*KEYS, "reason")
    return kept.unionByName(gone).withColumn("accepted", F.col("reason").isNull())


def stream_deliver_payload(spark, sf):
    base = work_dir(spark, "payload")
    sinks.append_payload(
        tables.event_stream(spark, sf), f"{base}/out", f"{base}/ck", line_sep="\n", **DONE
    ).awaitTermination()
    return spark.read.text(f"{base}/out").select(F.col("value").alias("payload"))


def stream_deliver_bytes(spark, sf):
    """Payloads with a terminator, kept as bytes and read back as bytes."""
    base = work_dir(spark, "bytes")
    events = tables.event_stream(spark, sf)
    odd = F.concat(F.lit(bytearray(b"\xff")), "data")
    payloads = events.withColumn("data", F.when(F.col("sequence_number").endswith("0"), odd).otherwise(F.col("data")))
    sinks.append_payload(payloads, f"{base}/out", f"{base}/ck", terminator=b"\n", **DONE).awaitTermination()
    return spark.read.parquet(f"{base}/out").select(F.hex("data").alias("payload_hex"))


def stream_write_rate(spark, sf):
    base = work_dir(spark, "rates")
    log.append_sync(tables.event_records(spark, sf), f"{base}/source")
    records = log.scan_stream(spark, f"{base}/source", max_files=3)
    rates.collect_traffic(records, f"{base}/out", f"{base}/ck", HOUR, **DONE).awaitTermination()
    over = rates.read_traffic(spark, f"{base}/out").where(F.col("n_records") > 8)
    start = F.col("window_start").cast("timestamp_ntz").alias("window_start")
    return over.select("stream", "shard_id", start, "n_records")


QUERIES = {
    "stream_append": stream_append,
    "stream_append_two_writers": stream_append_two_writers,
    "stream_deliver_two_writers": stream_deliver_two_writers,
    "stream_message_counts": stream_message_counts,
    "stream_deliver_bytes": stream_deliver_bytes,
    "stream_scan": stream_scan,
    "stream_latest": stream_latest,
    "stream_resume": stream_resume,
    "stream_drop_replays": stream_drop_replays,
    "stream_deliver": stream_deliver,
    "stream_listen": stream_listen,
    "stream_admit": stream_admit,
    "stream_deliver_payload": stream_deliver_payload,
    "stream_write_rate": stream_write_rate,
    "stream_scan_after_rerun": stream_scan_after_rerun,
    "stream_deliver_queue": stream_deliver_queue,
    "stream_append_new": stream_append_new,
    "stream_progress": stream_progress,
    "stream_admit_drained": stream_admit_drained,
}

ALL = f"{REC} SELECT {SHOWN} FROM rec"

ORACLES = {
    "stream_append": ALL,
    "stream_append_two_writers": ALL,
    "stream_deliver_two_writers": f"""{REC}, x AS (SELECT *, CAST(json_extract(payload, '$.k') AS BIGINT) AS k FROM rec)
SELECT stream, 'none: delivered' AS error_message, count(*) AS n_errors FROM x GROUP BY stream
UNION ALL SELECT stream, 'reset by peer', count(*) FROM x WHERE k = 7 GROUP BY stream""",
    "stream_message_counts": READING_SQL["message_counts"],
    "stream_deliver_bytes": f"""{REC} SELECT CASE WHEN event_id % 10 = 0 THEN 'FF' ELSE '' END || hex(encode(payload)) || '0A' AS payload_hex FROM rec""",
    "stream_scan": ALL,
    "stream_latest": LATEST_SQL,
    "stream_resume": ALL,
    "stream_drop_replays": READING_SQL["drop_replays"],
    "stream_deliver": f"""{REC}, x AS (SELECT *, CAST(json_extract(payload, '$.k') AS BIGINT) AS k FROM rec),
sent AS (SELECT x.*, CAST(a AS INTEGER) AS attempt, k % 10 = 0 OR (k % 10 = 1 AND a < 3) AS refused
  FROM x JOIN (VALUES (1), (2), (3)) AS t(a) ON a = 1 OR k % 10 IN (0, 1))
SELECT stream, partition_key, octet_length(encode(payload)) AS n_bytes, attempt,
  CASE WHEN refused THEN 'failed' ELSE 'delivered' END AS outcome,
  CASE WHEN refused THEN 'not now: ' || k END AS error_message FROM sent""",
    "stream_listen": READING_SQL["split_errors"],
    "stream_admit": DELIVERY_SQL["admit"],
    "stream_deliver_payload": "SELECT props AS payload FROM events",
    "stream_write_rate": DELIVERY_SQL["write_rate"],
    "stream_scan_after_rerun": ALL,
    "stream_append_new": READING_SQL["drop_replays"],
    "stream_progress": f"""WITH n AS (SELECT event_id % {PARTS} AS part, count(*) AS n FROM events GROUP BY ALL),
b AS (SELECT part, n FROM n UNION ALL SELECT part + {PARTS}, n FROM n),
t AS (SELECT sum(n) OVER (ORDER BY part) AS t, sum(n) OVER (ORDER BY part) - n AS before FROM b)
SELECT CAST(max(t) AS BIGINT) AS n_messages, count(*) FILTER (t // 100 > before // 100) AS n_lines FROM t""",
    "stream_deliver_queue": f"""{REC}, x AS (SELECT stream, event_id % {PARTS} AS part, CAST(json_extract(payload, '$.k') AS BIGINT) % 10 = 0 AS slow FROM rec),
sent AS (SELECT stream, least(part + a - 1, {PARTS - 1}) AS batch_id, CAST(a AS INTEGER) AS attempt,
    CASE WHEN slow AND a <= 5 THEN 'failed' ELSE 'delivered' END AS outcome
  FROM x JOIN range(1, 7) AS t(a) ON a = 1 OR slow)
SELECT *, count(*) AS n FROM sent GROUP BY ALL
UNION ALL SELECT stream, {PARTS - 1}, NULL, 'waiting', count(*) FROM x WHERE slow AND part + 5 > {PARTS - 1} GROUP BY stream""",
    "stream_admit_drained": f"""{REC.replace('WITH', 'WITH RECURSIVE', 1)}, n AS (
  SELECT shard_id, event_id % {PARTS} AS part, count(*) AS offered FROM rec GROUP BY ALL),
fill AS (
  SELECT s.shard_id, 0 AS part, 1000 AS room, least(coalesce(offered, 0), 1000) AS held
  FROM (SELECT DISTINCT shard_id FROM rec) s LEFT JOIN n ON n.shard_id = s.shard_id AND part = 0
  UNION ALL
  SELECT f.shard_id, f.part + 1, 1000 - greatest(held - 100, 0),
    greatest(held - 100, 0) + least(coalesce(offered, 0), 1000 - greatest(held - 100, 0))
  FROM fill f LEFT JOIN n ON n.shard_id = f.shard_id AND n.part = f.part + 1 WHERE f.part < {PARTS - 1}),
o AS (SELECT *, event_id % {PARTS} AS part, row_number() OVER (PARTITION BY shard_id, event_id % {PARTS} ORDER BY event_id) AS rn FROM rec)
SELECT stream, shard_id, sequence_number, rn <= room AS accepted,
  CASE WHEN rn > room THEN 'Channel is full, dropped message' END AS reason FROM o JOIN fill USING (shard_id, part)""",
}
