"""Queries on scans, start positions, checkpoints, fetches and user functions."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlog.functions.message import (
    key_bytes,
    message,
    position_name,
    set_value,
    status_name,
    value_text,
)
from shardlog.operators import consume, fetch, positions, status
from shardlog.operators.checkpoint import (
    checkpoint,
    drop_rare_replays,
    drop_replays,
    progress,
    resume,
)
from shardlog.plans import tables
from shardlog.schema import SHARD_KEYS
from shardlog.sources.log import append_sync, select_shards
from shardlog.workdir import materialised, work_dir

# Times at which readers in these queries stop, save or begin (see the SQL).
EARLY, CUT, LATE = "2024-01-10", "2024-01-16", "2024-01-20"

REC = """
WITH rec AS (
  SELECT 'events' AS stream,
         'shardId-' || lpad(CAST(user_id % 4 AS VARCHAR), 12, '0') AS shard_id,
         CAST(event_id AS VARCHAR) AS sequence_number,
         CAST(user_id AS VARCHAR) AS partition_key,
         props AS payload, event_id, user_id, ts, event_type
  FROM events
)
"""
SHOWN = "stream, shard_id, sequence_number, partition_key, payload"
PER_SHARD = """
  SELECT * FROM (VALUES
    ('shardId-000000000000', 'TRIM_HORIZON', NULL, NULL),
    ('shardId-000000000001', 'AT_SEQUENCE_NUMBER', 500, NULL),
    ('shardId-000000000002', 'AFTER_SEQUENCE_NUMBER', 502, NULL),
    ('shardId-000000000003', 'AT_TIMESTAMP', NULL, TIMESTAMP '2024-01-16')
  ) AS pos(shard_id, position, s, t)
"""
RULE = """
  CASE position WHEN 'TRIM_HORIZON' THEN true
    WHEN 'AT_SEQUENCE_NUMBER' THEN event_id >= s
    WHEN 'AFTER_SEQUENCE_NUMBER' THEN event_id > s
    WHEN 'AT_TIMESTAMP' THEN ts >= t END
"""
READ = f"{REC}, pos AS ({PER_SHARD}), red AS (SELECT rec.* FROM rec JOIN pos USING (shard_id) WHERE {RULE})"


def shown(records: DataFrame) -> DataFrame:
    keys = ["stream", "shard_id", "sequence_number", "partition_key"]
    return records.select(*keys, value_text().alias("payload"))


def before(records: DataFrame, day: str) -> DataFrame:
    return records.where(F.col("arrival_ts") < F.lit(day).cast("timestamp"))


def saved_at_cut(records: DataFrame) -> DataFrame:
    """Checkpoint of what was read before the cut; the last shard never saved one."""
    read = before(records, CUT).where(F.col("shard_id") != "shardId-000000000003")
    return checkpoint(read)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Left to read per shard from its own start position, and where it would end."""
    records = tables.event_records(spark, sf)
    return progress(positions.read_from_positions(records, tables.positions(spark)))


def scan_shard(spark, sf):
    typed = tables.typed_records(spark, sf)
    return shown(select_shards(typed, "purchase", [f"shardId-{n:012d}" for n in (1, 2)]))


def pos_trim_horizon(spark, sf):
    return shown(positions.from_trim_horizon(tables.event_records(spark, sf)))


def pos_latest(spark, sf):
    records = tables.event_records(spark, sf)
    return shown(positions.from_latest(records, checkpoint(before(records, CUT))))


def pos_at_sequence(spark, sf):
    return shown(positions.from_sequence(tables.event_records(spark, sf), "502"))


def pos_after_sequence(spark, sf):
    return shown(positions.from_after_sequence(tables.event_records(spark, sf), "502"))


def pos_at_timestamp(spark, sf):
    start = F.lit(CUT).cast("timestamp")
    return shown(positions.from_timestamp(tables.event_records(spark, sf), start))


def pos_per_shard(spark, sf):
    records = tables.event_records(spark, sf)
    return shown(positions.read_from_positions(records, tables.positions(spark)))


def log_positions(spark, sf):
    """The same from a stored log, where each kind of position prunes its own scan."""
    path = work_dir(spark, "log")
    append_sync(tables.event_records(spark, sf), path)
    return shown(positions.read_log_from_positions(spark, path, tables.positions(spark)))


def log_latest(spark, sf):
    """LATEST on a stored log: one shard has no mark and is read whole, the others are bounded."""
    path = work_dir(spark, "log")
    records = tables.event_records(spark, sf)
    append_sync(records, path)
    marks = checkpoint(before(records, CUT).where("shard_id <> 'shardId-000000000003'"))
    return shown(positions.read_log_from_latest(spark, path, marks))


def active_at_arrival(spark, sf):
    """Streams that are created, become active, are deleted and come back while records arrive."""
    kept = status.active_at_arrival(tables.typed_records(spark, sf), tables.status_history(spark))
    return shown(kept)


def rejected_at_arrival(spark, sf):
    refused = status.rejected_at_arrival(tables.typed_records(spark, sf), tables.status_history(spark))
    return refused.select(*SHARD_KEYS, "sequence_number", "reason")


def active_only(spark, sf):
    return shown(status.active_only(tables.typed_records(spark, sf), tables.streams(spark)))


def rejected_streams(spark, sf):
    """One event type is missing from the status table."""
    listed = tables.streams(spark).where("stream <> 'view'")
    refused = status.rejected(tables.typed_records(spark, sf), listed)
    return refused.groupBy("stream", "reason").agg(F.count(F.lit(1)).alias("n_messages"))


def code_names(spark, sf):
    code = F.col("user_id") % 9
    return (
        tables.events(spark, sf)
        .groupBy(code.alias("code"))
        .agg(F.count(F.lit(1)).alias("n_events"))
        .withColumn("position", position_name(F.col("code")))
        .withColumn("status", status_name(F.col("code")))
    )


def message_parts(spark, sf):
    records = tables.event_records(spark, sf)
    named = F.concat_ws(" ", F.col("partition_key"), value_text())
    changed = set_value(records, F.encode(named, "UTF-8"))
    sent = message(F.col("data"), F.col("partition_key")).alias("sent")
    return changed.select(
        "sequence_number", F.hex(key_bytes()).alias("key_hex"), sent
    ).select(
        "sequence_number",
        "key_hex",
        F.decode("sent.data", "UTF-8").alias("sent_text"),
        F.col("sent.partition_key").alias("sent_key"),
        F.col("sent.sequence_number").isNull().alias("unsequenced"),
    )


def fetch_batches(spark, sf):
    fetched = fetch.fetch_batches(tables.event_records(spark, sf), 500)
    return fetched.select(*SHARD_KEYS, "sequence_number", "fetch_no")


def checkpoint_query(spark, sf):
    return checkpoint(tables.event_records(spark, sf))


def resume_inclusive(spark, sf):
    records = tables.event_records(spark, sf)
    return shown(resume(records, tables.positions(spark), saved_at_cut(records)))


def resume_exclusive(spark, sf):
    records = tables.event_records(spark, sf)
    saved = saved_at_cut(records)
    return shown(resume(records, tables.positions(spark), saved, inclusive=False))


def replayed(records: DataFrame, spark: SparkSession) -> DataFrame:
    """A reader that stopped late and resumed from a checkpoint it had saved early."""
    first = before(records, LATE)
    second = resume(records, tables.positions(spark), checkpoint(before(records, EARLY)))
    return first.unionByName(second)


def drop_replays_query(spark, sf):
    return shown(drop_replays(replayed(tables.event_records(spark, sf), spark)))


def drop_rare_replays_query(spark, sf):
    return shown(drop_rare_replays(replayed(tables.event_records(spark, sf), spark)))


def user_records(spark, sf):
    """One shard per user."""
    shard = F.concat(F.lit("user "), "partition_key").alias("shard_id")
    records = tables.event_records(spark, sf)
    return records.select("stream", shard, *[c for c in records.columns if c not in SHARD_KEYS])


def user_positions(records):
    """Every user is read from the number after 40 times the user's own."""
    number = (40 * F.col("partition_key").cast("long")).cast("string")
    return records.select(
        *SHARD_KEYS,
        F.lit("AFTER_SEQUENCE_NUMBER").alias("position"),
        number.alias("sequence_number"),
        F.lit(None).cast("timestamp").alias("at_ts"),
    ).distinct()


def log_positions_per_user(spark, sf):
    """As many shards as users, from a stored log."""
    records, path = user_records(spark, sf), work_dir(spark, "log")
    append_sync(records, path)
    return shown(positions.read_log_from_positions(spark, path, user_positions(records)))


def resume_per_user(spark, sf):
    records = user_records(spark, sf)
    saved = checkpoint(before(records, CUT).where(F.col("partition_key").cast("long") % 3 != 0))
    return shown(resume(records, user_positions(records), saved, inclusive=False))


def retrieve_unnumbered(spark, sf):
    """Some events have no number, some an empty one, and none a length; errors come in between."""
    records = tables.event_records(spark, sf)
    kind = F.col("sequence_number").cast("long") % 5
    number = F.when(kind == 1, F.lit("")).when(kind != 0, F.col("sequence_number"))
    odd = records.withColumn("sequence_number", number).withColumn("sequence_len", F.lit(None).cast("int"))
    failed = records.where("sequence_number % 7 = 3").withColumn("error_message", F.lit("cannot read"))
    found = fetch.retrieve_or_error(odd, failed)
    return found.select(*SHARD_KEYS, "sequence_number", "error_message")


def conversation_progress(spark, sf):
    """How far each shard of the conversations goes, when all are read from the tenth on."""
    turns = tables.conversation_records(spark, sf)
    return progress(positions.from_sequence(turns, "10000000"))


def retrieve_next(spark, sf):
    records = tables.event_records(spark, sf)
    left = positions.read_from_positions(records, tables.positions(spark))
    return shown(fetch.retrieve(left))


def parse_k(payload: bytes) -> int:
    return json.loads(payload)["k"]


def parse_k_or_fail(payload: bytes) -> int:
    k = json.loads(payload)["k"]
    if k % 10 == 0:
        raise ValueError(f"cannot use k = {k}")
    return k


def retrieve_fn(spark, sf):
    records = tables.event_records(spark, sf)
    left = positions.read_from_positions(records, tables.positions(spark))
    return consume.retrieve_fn(left, parse_k, "bigint")


def message_counts(spark, sf):
    return consume.message_counts(tables.event_records(spark, sf))


def map_payload(spark, sf):
    return consume.for_each_message(tables.event_records(spark, sf), parse_k, "bigint")


def split_errors(spark, sf):
    outcomes = consume.for_each_message(
        tables.event_records(spark, sf), parse_k_or_fail, "bigint"
    )
    good, errors = consume.split_errors(materialised(outcomes, "outcomes"))
    return good.unionByName(errors, allowMissingColumns=True)


QUERIES = {
    "left_to_read": flagship,
    "scan_shard": scan_shard,
    "pos_trim_horizon": pos_trim_horizon,
    "pos_latest": pos_latest,
    "pos_at_sequence": pos_at_sequence,
    "pos_after_sequence": pos_after_sequence,
    "pos_at_timestamp": pos_at_timestamp,
    "pos_per_shard": pos_per_shard,
    "log_positions": log_positions,
    "log_latest": log_latest,
    "active_at_arrival": active_at_arrival,
    "rejected_at_arrival": rejected_at_arrival,
    "active_only": active_only,
    "rejected_streams": rejected_streams,
    "code_names": code_names,
    "message_parts": message_parts,
    "fetch_batches": fetch_batches,
    "checkpoint": checkpoint_query,
    "resume": resume_inclusive,
    "resume_exclusive": resume_exclusive,
    "drop_replays": drop_replays_query,
    "drop_rare_replays": drop_rare_replays_query,
    "retrieve_next": retrieve_next,
    "retrieve_unnumbered": retrieve_unnumbered,
    "conversation_progress": conversation_progress,
    "log_positions_per_user": log_positions_per_user,
    "resume_per_user": resume_per_user,
    "retrieve_fn": retrieve_fn,
    "message_counts": message_counts,
    "map_payload": map_payload,
    "split_errors": split_errors,
}

LATEST_SQL = f"""{REC}, mark AS (
  SELECT shard_id, max(event_id) AS m FROM rec WHERE ts < TIMESTAMP '{CUT}' GROUP BY shard_id)
SELECT {SHOWN} FROM rec LEFT JOIN mark USING (shard_id) WHERE m IS NULL OR event_id > m"""


def _resume_sql(comparison: str) -> str:
    return f"""{REC}, pos AS ({PER_SHARD}), saved AS (
  SELECT shard_id, max(event_id) AS m FROM rec
  WHERE ts < TIMESTAMP '{CUT}' AND shard_id <> 'shardId-000000000003' GROUP BY shard_id)
SELECT {SHOWN} FROM rec JOIN pos USING (shard_id) LEFT JOIN saved USING (shard_id)
WHERE CASE WHEN m IS NOT NULL THEN event_id {comparison} m ELSE {RULE} END"""


REPLAYS_SQL = f"""{REC}, saved AS (
  SELECT shard_id, max(event_id) AS m FROM rec WHERE ts < TIMESTAMP '{EARLY}' GROUP BY shard_id),
twice AS (SELECT {SHOWN} FROM rec WHERE ts < TIMESTAMP '{LATE}'
  UNION ALL SELECT {SHOWN} FROM rec JOIN saved USING (shard_id) WHERE event_id >= m)
SELECT DISTINCT {SHOWN} FROM twice"""
K = "CAST(json_extract(payload, '$.k') AS BIGINT)"
STATUSES = """
  SELECT * FROM (VALUES ('signup', 'CREATING'), ('error', 'DELETING'), ('click', 'ACTIVE'),
    ('view', 'UPDATING'), ('purchase', NULL)) AS s(stream, status)
"""

HISTORY = """
  SELECT stream, status, CAST(since AS TIMESTAMP) AS since FROM (VALUES ('signup', 'CREATING', '2024-01-03'), ('signup', 'ACTIVE', '2024-01-05 06:00:00'),
    ('signup', 'DELETING', '2024-01-12'), ('signup', 'ACTIVE', '2024-01-20 12:30:00'), ('click', 'ACTIVE', '2023-12-31'),
    ('view', 'ACTIVE', '2024-01-02'), ('view', NULL, '2024-01-15'), ('view', 'UPDATING', '2024-01-25'),
    ('error', 'CREATING', '2024-01-10')) AS h(stream, status, since)
"""
ARRIVED = f"""{REC}, h AS ({HISTORY}),
met AS (SELECT rec.* EXCLUDE (stream), event_type AS stream, h.status, h.since FROM rec ASOF LEFT JOIN h ON rec.event_type = h.stream AND rec.ts >= h.since)
"""

ORACLES = {
    "log_latest": LATEST_SQL.replace("GROUP BY shard_id)", "AND shard_id <> 'shardId-000000000003' GROUP BY shard_id)"),
    "active_at_arrival": f"{ARRIVED} SELECT {SHOWN} FROM met WHERE status = 'ACTIVE'",
    "rejected_at_arrival": f"""{ARRIVED} SELECT stream, shard_id, sequence_number, CASE WHEN since IS NULL THEN 'The Stream is not known'
  WHEN status IS NULL THEN 'Nil stream status' ELSE 'The Stream is not yet active' END AS reason
FROM met WHERE status IS DISTINCT FROM 'ACTIVE'""",
    "left_to_read": f"""{READ}
SELECT stream, shard_id, count(*) AS n_messages, CAST(max(event_id) AS VARCHAR) AS checkpoint
FROM red GROUP BY stream, shard_id""",
    "scan_shard": f"""{REC}
SELECT event_type AS stream, shard_id, sequence_number, partition_key, payload FROM rec
WHERE event_type = 'purchase' AND shard_id IN ('shardId-000000000001', 'shardId-000000000002')""",
    "pos_trim_horizon": f"{REC} SELECT {SHOWN} FROM rec",
    "pos_latest": LATEST_SQL,
    "pos_at_sequence": f"{REC} SELECT {SHOWN} FROM rec WHERE event_id >= 502",
    "pos_after_sequence": f"{REC} SELECT {SHOWN} FROM rec WHERE event_id > 502",
    "pos_at_timestamp": f"{REC} SELECT {SHOWN} FROM rec WHERE ts >= TIMESTAMP '{CUT}'",
    "pos_per_shard": f"{READ} SELECT {SHOWN} FROM red",
    "active_only": f"""{REC}, st AS ({STATUSES})
SELECT event_type AS stream, shard_id, sequence_number, partition_key, payload
FROM rec JOIN st ON event_type = st.stream WHERE status = 'ACTIVE'""",
    "rejected_streams": f"""{REC}, st AS (SELECT * FROM ({STATUSES}) WHERE stream <> 'view')
SELECT event_type AS stream,
  CASE WHEN st.stream IS NULL THEN 'The Stream is not known' WHEN status IS NULL THEN 'Nil stream status'
    ELSE 'The Stream is not yet active' END AS reason,
  count(*) AS n_messages
FROM rec LEFT JOIN st ON event_type = st.stream
WHERE status IS NULL OR status <> 'ACTIVE' GROUP BY 1, 2""",
    "code_names": """
SELECT user_id % 9 AS code, count(*) AS n_events,
  CASE user_id % 9 WHEN 0 THEN 'AT_SEQUENCE_NUMBER' WHEN 1 THEN 'AFTER_SEQUENCE_NUMBER'
    WHEN 2 THEN 'TRIM_HORIZON' WHEN 3 THEN 'LATEST' ELSE '' END AS position,
  CASE user_id % 9 WHEN 4 THEN 'CREATING' WHEN 5 THEN 'DELETING' WHEN 6 THEN 'ACTIVE'
    WHEN 7 THEN 'UPDATING' ELSE '' END AS status
FROM events GROUP BY user_id % 9""",
    "message_parts": f"""{REC}
SELECT sequence_number, hex(encode(partition_key)) AS key_hex, partition_key || ' ' || payload AS sent_text,
  partition_key AS sent_key, true AS unsequenced FROM rec""",
    "fetch_batches": f"""{REC}
SELECT stream, shard_id, sequence_number,
  CAST((row_number() OVER (PARTITION BY shard_id ORDER BY event_id) - 1) // 500 AS BIGINT) AS fetch_no
FROM rec""",
    "checkpoint": f"""{REC}
SELECT stream, shard_id, CAST(max(event_id) AS VARCHAR) AS sequence_number,
  CAST(length(CAST(max(event_id) AS VARCHAR)) AS INTEGER) AS sequence_len
FROM rec GROUP BY stream, shard_id""",
    "resume": _resume_sql(">="),
    "resume_exclusive": _resume_sql(">"),
    "drop_replays": REPLAYS_SQL,
    "drop_rare_replays": REPLAYS_SQL,
    "log_positions": f"{READ} SELECT {SHOWN} FROM red",
    "retrieve_unnumbered": f"""{REC}, offered AS (
  SELECT stream, shard_id, event_id, CAST(NULL AS VARCHAR) AS error_message, 1 AS rank FROM rec WHERE event_id % 5 > 1
  UNION ALL SELECT stream, shard_id, event_id, 'cannot read', 0 FROM rec WHERE event_id % 7 = 3)
SELECT stream, shard_id, CAST(event_id AS VARCHAR) AS sequence_number, error_message FROM offered
QUALIFY row_number() OVER (PARTITION BY shard_id ORDER BY event_id, rank) = 1""",
    "conversation_progress": """
SELECT role AS stream, 'shardId-' || lpad(CAST(conv_id % 4 AS VARCHAR), 12, '0') AS shard_id,
  count(*) AS n_messages, CAST(max(conv_id * 1000000 + turn) AS VARCHAR) AS checkpoint
FROM conversations WHERE conv_id >= 10 GROUP BY 1, 2""",
    "log_positions_per_user": f"""{REC}
SELECT stream, 'user ' || user_id AS shard_id, sequence_number, partition_key, payload FROM rec WHERE event_id > 40 * user_id""",
    "resume_per_user": f"""{REC}, saved AS (
  SELECT user_id, max(event_id) AS m FROM rec WHERE ts < TIMESTAMP '{CUT}' AND user_id % 3 <> 0 GROUP BY user_id)
SELECT stream, 'user ' || user_id AS shard_id, sequence_number, partition_key, payload
FROM rec LEFT JOIN saved USING (user_id) WHERE event_id > coalesce(m, 40 * user_id)""",
    "retrieve_next": f"""{READ}
SELECT {SHOWN} FROM red JOIN (SELECT shard_id, min(event_id) AS event_id FROM red GROUP BY shard_id)
USING (shard_id, event_id)""",
    "retrieve_fn": f"""{READ}
SELECT stream, shard_id, sequence_number, {K} AS value, CAST(NULL AS VARCHAR) AS error_message
FROM red JOIN (SELECT shard_id, min(event_id) AS event_id FROM red GROUP BY shard_id)
USING (shard_id, event_id)""",
    "message_counts": f"{REC} SELECT stream, shard_id, count(*) AS n_messages FROM rec GROUP BY 1, 2",
    "map_payload": f"""{REC}
SELECT stream, shard_id, sequence_number, {K} AS value, CAST(NULL AS VARCHAR) AS error_message
FROM rec""",
    "split_errors": f"""{REC}
SELECT stream, shard_id, sequence_number,
  CASE WHEN {K} % 10 <> 0 THEN {K} END AS value,
  CASE WHEN {K} % 10 = 0 THEN 'cannot use k = ' || {K} END AS error_message FROM rec""",
}
