"""Queries on admission, put requests, responses and quotas."""

from pyspark.sql import functions as F

from shardlog.functions.message import value_text
from shardlog.operators import consume, delivery, pacing, produce, quota, requests
from shardlog.plans import tables
from shardlog.plans.reading import REC
from shardlog.schema import SHARD_KEYS
from shardlog.sources import log

HOUR = "1 hour"


def admit(spark, sf):
    offered = produce.admit(tables.event_records(spark, sf), concurrency=2)
    return offered.select(*SHARD_KEYS, "sequence_number", "accepted", "reason")


def admit_by_hour(spark, sf):
    """Offers are ordered by the hour alone, so most of them tie; how many fit is exact."""
    records = tables.event_records(spark, sf)
    offers = records.withColumn("hour", F.date_trunc("hour", "arrival_ts"))
    marked = produce.admit(offers, concurrency=2, order_by=["hour"])
    counts = marked.groupBy(*SHARD_KEYS, "hour").agg(F.count_if("accepted").alias("n_accepted"), F.count(F.lit(1)).alias("n_offers"))
    return counts.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


def put_shape(spark, sf):
    shaped = produce.put_shape(tables.event_records(spark, sf), 500)
    return shaped.select(
        "stream", "request_id", "idx", "partition_key", value_text().alias("payload")
    )


def _outcomes(spark, sf):
    requests = tables.sent_requests(spark, sf)
    return delivery.reconcile(requests, *tables.responses(requests))


def reconcile(spark, sf):
    return _outcomes(spark, sf).drop("data")


def _text(retried):
    return retried.select("stream", "partition_key", value_text().alias("payload"))


def retry_set(spark, sf):
    return _text(delivery.retry_set(_outcomes(spark, sf)))


def retry_keyless(spark, sf):
    return _text(delivery.retry_keyless(_outcomes(spark, sf)))


def delivery_counts(spark, sf):
    return delivery.delivery_counts(_outcomes(spark, sf))


def delivery_counts_keyless(spark, sf):
    requests = tables.sent_requests(spark, sf)
    return delivery.delivery_counts_keyless(requests, *tables.responses(requests))


def error_counts(spark, sf):
    return consume.error_counts(delivery.delivery_errors(_outcomes(spark, sf)))


def deliver_payload(spark, sf):
    sent = log.deliver_payload(tables.event_records(spark, sf), b"\n")
    return sent.select(value_text().alias("payload"))


def _hours(windows):
    return windows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


HOUR_MICROS = 3_600_000_000


def write_schedule(spark, sf):
    """At most 4 sends of a shard in any hour: when each record goes out, and how many wait before it."""
    sent = pacing.with_backlog(pacing.write_schedule(tables.event_records(spark, sf), 4, HOUR_MICROS))
    at = F.col("send_ts").cast("timestamp_ntz").alias("send_ts")
    return sent.select(*SHARD_KEYS, "sequence_number", at, "waiting")


def read_schedule(spark, sf):
    """Fetches of 3 records, at most 2 of a shard in any hour."""
    made = pacing.read_schedule(tables.event_records(spark, sf), 3, 2, HOUR_MICROS)
    times = (F.col(c).cast("timestamp_ntz").alias(c) for c in ("ready_ts", "fetch_ts"))
    return made.select(*SHARD_KEYS, "fetch_no", "n_records", *times)


def write_peak(spark, sf):
    """The fullest hour of each shard, wherever it begins."""
    peaks = quota.write_peak(tables.event_records(spark, sf), 9, 120, HOUR_MICROS)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("records_at", "bytes_at")}
    return peaks.withColumns(times)


def delivery_peak(spark, sf):
    peaks = quota.delivery_peak(tables.typed_records(spark, sf), 12, 100, HOUR_MICROS)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("records_at", "bytes_at")}
    return peaks.withColumns(times)


def put_shape_bytes(spark, sf):
    """Document texts in requests of at most 10 records and 20,000 bytes."""
    shaped = requests.put_shape_bytes(tables.document_records(spark, sf), 10, 20_000)
    return shaped.select("stream", "request_id", "idx", "partition_key", value_text().alias("payload"))


def oversized_after_shaping(spark, sf):
    """Of the requests that ``put_shape_bytes`` makes only single records exceed the limits."""
    shaped = requests.put_shape_bytes(tables.document_records(spark, sf), 10, 20_000)
    return quota.oversized_requests(shaped, 10, 20_000)


def read_rate(spark, sf):
    records = tables.event_records(spark, sf)
    return _hours(quota.read_rate(records, per_fetch=3, limit=2, every=HOUR))


def write_rate(spark, sf):
    return _hours(quota.write_rate(tables.event_records(spark, sf), limit=8, every=HOUR))


def write_bytes(spark, sf):
    return _hours(quota.write_bytes(tables.event_records(spark, sf), limit=90, every=HOUR))


def delivery_rate(spark, sf):
    over = quota.delivery_rate(
        tables.event_records(spark, sf),
        per_request=5,
        max_requests=4,
        max_records=22,
        max_bytes=210,
        every=HOUR,
    )
    return _hours(over)


def oversized_records(spark, sf):
    over = quota.oversized_records(tables.document_records(spark, sf), limit=10_000)
    return over.select(
        "stream", "sequence_number", F.octet_length("data").cast("long").alias("n_bytes")
    )


def oversized_requests(spark, sf):
    requests = produce.put_shape(tables.document_records(spark, sf), 20)
    return quota.oversized_requests(requests, max_records=19, max_bytes=60_000)


def oversized_calls(spark, sf):
    requests = produce.put_shape(tables.document_records(spark, sf), 20)
    return quota.oversized_calls(requests, max_records=19, max_bytes=60_000)


QUERIES = {
    "admit": admit,
    "admit_by_hour": admit_by_hour,
    "put_shape": put_shape,
    "reconcile": reconcile,
    "retry_set": retry_set,
    "retry_keyless": retry_keyless,
    "delivery_counts": delivery_counts,
    "delivery_counts_keyless": delivery_counts_keyless,
    "error_counts": error_counts,
    "deliver_payload": deliver_payload,
    "write_schedule": write_schedule,
    "read_schedule": read_schedule,
    "write_peak": write_peak,
    "delivery_peak": delivery_peak,
    "put_shape_bytes": put_shape_bytes,
    "oversized_after_shaping": oversized_after_shaping,
    "read_rate": read_rate,
    "write_rate": write_rate,
    "write_bytes": write_bytes,
    "delivery_rate": delivery_rate,
    "oversized_records": oversized_records,
    "oversized_requests": oversized_requests,
    "oversized_calls": oversized_calls,
}


def _requests(source: str, per_request: int) -> str:
    """Requests numbered on from shard to shard, over ``source``'s keys and order ``n``."""
    return f"""
  placed AS (SELECT *, row_number() OVER (PARTITION BY stream, shard_id ORDER BY n) - 1 AS p FROM {source}),
  sizes AS (SELECT stream, shard_id, ceil(count(*) / {per_request}.0) AS c FROM placed GROUP BY 1, 2),
  firsts AS (SELECT stream, shard_id, coalesce(sum(c) OVER (ORDER BY stream, shard_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM sizes),
  req AS (SELECT stream, CAST(first + p // {per_request} AS BIGINT) AS request_id,
    CAST(p % {per_request} AS INTEGER) AS idx, partition_key, payload
    FROM placed JOIN firsts USING (stream, shard_id))
"""


PUT = f"{REC}, src AS (SELECT *, event_id AS n FROM rec), {_requests('src', 500)}"
SENT = f"""{REC}, src AS (SELECT * REPLACE (event_type || ' ' || payload AS payload), event_id AS n FROM rec),
{_requests("src", 500)},
outcome AS (SELECT *, request_id % 7 <> 3 AS answered,
    request_id % 7 NOT IN (3, 5) AND starts_with(payload, 'error') AS failed FROM req)
"""
MESSAGE = "CASE WHEN failed THEN CASE WHEN idx % 2 = 0 THEN '' ELSE 'cannot store record of key ' || partition_key END END"
RETRIED = "FROM outcome WHERE failed OR NOT answered"
PER_HOUR = f"""{REC}, w AS (
  SELECT stream, shard_id, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n_records,
    CAST(sum(octet_length(encode(payload)) + octet_length(encode(partition_key))) AS BIGINT) AS n_bytes
  FROM rec GROUP BY 1, 2, 3)
"""
SOURCES = f"""
WITH src AS (SELECT source AS stream, 'shardId-' || lpad(CAST(doc_id % 4 AS VARCHAR), 12, '0') AS shard_id,
  CAST(doc_id AS VARCHAR) AS partition_key, text AS payload, doc_id AS n FROM documents),
{_requests("src", 20)}
"""

# One record after the other: a request is closed where the next record does not fit.
CUT = f"""
WITH RECURSIVE src AS (SELECT source AS stream, 'shardId-' || lpad(CAST(doc_id % 4 AS VARCHAR), 12, '0') AS shard_id,
  CAST(doc_id AS VARCHAR) AS partition_key, text AS payload, doc_id AS n FROM documents),
placed AS MATERIALIZED (SELECT *, coalesce(octet_length(encode(payload)), 0) + octet_length(encode(partition_key)) AS size,
  row_number() OVER (PARTITION BY stream, shard_id ORDER BY n) AS p FROM src),
cut AS (
  SELECT stream, shard_id, p, CAST(0 AS BIGINT) AS no, 0 AS idx, size AS held FROM placed WHERE p = 1
  UNION ALL
  SELECT c.stream, c.shard_id, x.p, c.no + CAST(closes AS BIGINT), CASE WHEN closes THEN 0 ELSE c.idx + 1 END, CASE WHEN closes THEN size ELSE held + size END
  FROM (SELECT c.*, x.p AS next, c.idx = 9 OR c.held + x.size > 20000 AS closes
        FROM cut c JOIN placed x ON x.stream = c.stream AND x.shard_id = c.shard_id AND x.p = c.p + 1) c
  JOIN placed x ON x.stream = c.stream AND x.shard_id = c.shard_id AND x.p = c.next),
firsts AS (SELECT stream, shard_id, coalesce(sum(c) OVER (ORDER BY stream, shard_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
  FROM (SELECT stream, shard_id, max(no) + 1 AS c FROM cut GROUP BY ALL)),
req AS (SELECT stream, CAST(first + no AS BIGINT) AS request_id, idx, partition_key, payload, size
  FROM cut JOIN placed USING (stream, shard_id, p) JOIN firsts USING (stream, shard_id))
"""
# One record after the other, each a turn of ``limit`` behind the one that it has to wait for.
PACED = """
sent AS (
  SELECT stream, shard_id, i, a, a AS d FROM placed WHERE i < {limit}
  UNION ALL
  SELECT x.stream, x.shard_id, x.i, x.a, greatest(x.a, s.d + INTERVAL 1 HOUR)
  FROM sent s JOIN placed x ON x.stream = s.stream AND x.shard_id = s.shard_id AND x.i = s.i + {limit})
"""
PEAK = """, w AS (
  SELECT {keys}, ts, count(*) OVER last AS n, sum(size) OVER last AS b FROM sized
  WINDOW last AS (PARTITION BY {keys} ORDER BY ts RANGE BETWEEN INTERVAL '59 minutes 59.999999 seconds' PRECEDING AND CURRENT ROW))
SELECT {keys}, max(n) AS n_records, arg_min(ts, (-n, ts)) AS records_at, CAST(max(b) AS BIGINT) AS n_bytes, arg_min(ts, (-b, ts)) AS bytes_at,
  max(n) > {records} OR max(b) > {bytes} AS exceeded FROM w GROUP BY ALL"""

ORACLES = {
    "write_schedule": f"""{REC.replace("WITH", "WITH RECURSIVE", 1)}, placed AS MATERIALIZED (
  SELECT stream, shard_id, sequence_number, ts AS a, row_number() OVER (PARTITION BY shard_id ORDER BY ts, event_id) - 1 AS i FROM rec),
{PACED.format(limit=4)}, gone AS (SELECT shard_id, d, count(*) OVER (PARTITION BY shard_id ORDER BY d) AS n FROM sent)
SELECT p.stream, p.shard_id, p.sequence_number, s.d AS send_ts, CAST(greatest(p.i - coalesce(g.n, 0), 0) AS BIGINT) AS waiting
FROM placed p JOIN sent s ON p.shard_id = s.shard_id AND p.i = s.i
ASOF LEFT JOIN (SELECT DISTINCT * FROM gone) g ON p.shard_id = g.shard_id AND p.a >= g.d""",
    "read_schedule": f"""{REC.replace("WITH", "WITH RECURSIVE", 1)}, numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY shard_id ORDER BY event_id) - 1) // 3 AS i FROM rec),
placed AS MATERIALIZED (SELECT stream, shard_id, i, n, max(m) OVER (PARTITION BY shard_id ORDER BY i) AS a
  FROM (SELECT stream, shard_id, i, count(*) AS n, max(ts) AS m FROM numbered GROUP BY ALL)),
{PACED.format(limit=2)}
SELECT stream, shard_id, CAST(i AS BIGINT) AS fetch_no, n AS n_records, a AS ready_ts, d AS fetch_ts
FROM sent JOIN placed USING (stream, shard_id, i, a)""",
    "write_peak": f"""{REC}, sized AS (SELECT *, octet_length(encode(payload)) + octet_length(encode(partition_key)) AS size FROM rec)
{PEAK.format(keys="stream, shard_id", records=9, bytes=120)}""",
    "delivery_peak": f"""{REC}, sized AS (SELECT event_type AS stream, ts, octet_length(encode(payload)) AS size FROM rec)
{PEAK.format(keys="stream", records=12, bytes=100)}""",
    "put_shape_bytes": f"{CUT} SELECT stream, request_id, idx, partition_key, payload FROM req",
    "oversized_after_shaping": f"""{CUT} SELECT stream, request_id, count(*) AS n_records, CAST(sum(size) AS BIGINT) AS n_bytes
FROM req GROUP BY stream, request_id HAVING count(*) > 10 OR sum(size) > 20000""",
    "admit_by_hour": f"""{REC}, h AS (SELECT stream, shard_id, date_trunc('hour', ts) AS hour, count(*) AS n FROM rec GROUP BY ALL),
  b AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY shard_id ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM h)
SELECT stream, shard_id, hour, CAST(least(n, greatest(2000 - before, 0)) AS BIGINT) AS n_accepted, n AS n_offers FROM b""",
    "admit": f"""{REC}, o AS (
  SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY event_id) AS rn FROM rec)
SELECT stream, shard_id, sequence_number, rn <= 2000 AS accepted,
  CASE WHEN rn > 2000 THEN 'Channel is full, dropped message' END AS reason FROM o""",
    "put_shape": f"{PUT} SELECT stream, request_id, idx, partition_key, payload FROM req",
    "reconcile": f"""{SENT}
SELECT stream, request_id, idx, partition_key, answered, failed,
  CASE WHEN failed THEN CASE WHEN idx % 2 = 0 THEN 'InternalFailure' ELSE '' END END AS error_code,
  {MESSAGE} AS error_message FROM outcome""",
    "retry_set": f"{SENT} SELECT stream, partition_key, payload {RETRIED}",
    "retry_keyless": f"{SENT} SELECT stream, '' AS partition_key, payload {RETRIED}",
    "delivery_counts": f"""{SENT}
SELECT stream, count(*) - count(*) FILTER (failed) AS n_messages,
  count(*) FILTER (answered AND NOT failed) AS n_delivered FROM outcome GROUP BY stream""",
    "delivery_counts_keyless": f"""{SENT}, heads AS (
  SELECT request_id, any_value(stream) AS stream, count(*) AS n, count(*) FILTER (failed) AS failed_count
  FROM outcome WHERE answered GROUP BY request_id)
SELECT stream, CAST(sum(CASE WHEN failed_count > 0 THEN n - failed_count ELSE n END) AS BIGINT) AS n_messages
FROM heads GROUP BY stream""",
    "error_counts": f"""{SENT}
SELECT stream, {MESSAGE} AS error_message, count(*) AS n_errors FROM outcome WHERE failed GROUP BY 1, 2""",
    "deliver_payload": "SELECT props || chr(10) AS payload FROM events",
    "read_rate": f"""{PER_HOUR}
SELECT stream, shard_id, window_start, n_records, CAST(ceil(n_records / 3.0) AS BIGINT) AS n_fetches
FROM w WHERE ceil(n_records / 3.0) > 2""",
    "write_rate": f"{PER_HOUR} SELECT stream, shard_id, window_start, n_records FROM w WHERE n_records > 8",
    "write_bytes": f"{PER_HOUR} SELECT stream, shard_id, window_start, n_bytes FROM w WHERE n_bytes > 90",
    "delivery_rate": f"""{REC}, w AS (
  SELECT stream, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n_records,
    CAST(sum(octet_length(encode(payload))) AS BIGINT) AS n_bytes FROM rec GROUP BY 1, 2)
SELECT stream, window_start, n_records, n_bytes, CAST(ceil(n_records / 5.0) AS BIGINT) AS n_requests
FROM w WHERE ceil(n_records / 5.0) > 4 OR n_records > 22 OR n_bytes > 210""",
    "oversized_records": """
SELECT source AS stream, CAST(doc_id AS VARCHAR) AS sequence_number,
  octet_length(encode(text)) AS n_bytes FROM documents WHERE octet_length(encode(text)) > 10000""",
    "oversized_requests": f"""{SOURCES}
SELECT stream, request_id, count(*) AS n_records,
  CAST(sum(octet_length(encode(payload)) + octet_length(encode(partition_key))) AS BIGINT) AS n_bytes
FROM req GROUP BY 1, 2 HAVING count(*) > 19 OR n_bytes > 60000""",
    "oversized_calls": f"""{SOURCES}
SELECT stream, request_id, count(*) AS n_records,
  CAST(sum(octet_length(encode(payload))) AS BIGINT) AS n_bytes
FROM req GROUP BY 1, 2 HAVING count(*) > 19 OR n_bytes > 60000""",
}
