"""Record, request and response tables derived from the given Parquet tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlog.functions.message import value_text
from shardlog.operators.produce import put_shape
from shardlog.workdir import materialised

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def _shard(key: Column) -> Column:
    return F.concat(F.lit("shardId-"), F.lpad((key % 4).cast("string"), 12, "0"))


def records_from(
    table: DataFrame, stream: Column, number: Column, key: Column, payload: Column, arrival: Column
) -> DataFrame:
    """RECORD columns from a table whose ``number`` column orders each shard."""
    number = number.cast("string")
    return table.select(
        stream.alias("stream"),
        _shard(key).alias("shard_id"),
        number.alias("sequence_number"),
        F.length(number).alias("sequence_len"),
        key.cast("string").alias("partition_key"),
        F.encode(payload, "UTF-8").alias("data"),
        arrival.cast("timestamp").alias("arrival_ts"),
    )


def records_from_events(events: DataFrame, stream: Column | None = None) -> DataFrame:
    return records_from(
        events,
        F.lit("events") if stream is None else stream,
        F.col("event_id"),
        F.col("user_id"),
        F.col("props"),
        F.col("ts"),
    )


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf}/events.parquet")


def event_records(spark: SparkSession, sf: str) -> DataFrame:
    """One stream named ``events``, four shards by user."""
    return records_from_events(events(spark, sf))


def typed_records(spark: SparkSession, sf: str) -> DataFrame:
    """One stream per event type."""
    return records_from_events(events(spark, sf), F.col("event_type"))


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """``event_records`` as a streaming DataFrame."""
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet")
    return records_from_events(reader.parquet(sf))


def delivery_records(spark: SparkSession, sf: str) -> DataFrame:
    """Event records whose payload names the event type, for the delivery queries."""
    payload = F.concat_ws(" ", "event_type", "props")
    columns = F.lit("events"), F.col("event_id"), F.col("user_id"), payload, F.col("ts")
    return records_from(events(spark, sf), *columns)


def document_records(spark: SparkSession, sf: str) -> DataFrame:
    """Whole document texts as payloads, one stream per source."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    start = F.lit("2024-01-01").cast("timestamp")
    return records_from(docs, F.col("source"), F.col("doc_id"), F.col("doc_id"), F.col("text"), start)


def conversation_records(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of conversations in order, one stream per role."""
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    number = F.col("conv_id") * 1_000_000 + F.col("turn")
    start = F.lit("2024-01-01").cast("timestamp")
    return records_from(turns, F.col("role"), number, F.col("conv_id"), F.col("text"), start)


def positions(spark: SparkSession) -> DataFrame:
    """A different start position for each of the four event shards."""
    return spark.sql(
        """
        SELECT 'events' AS stream, shard_id, position, sequence_number,
               CAST(CAST(at AS TIMESTAMP_NTZ) AS TIMESTAMP) AS at_ts
        FROM VALUES
          ('shardId-000000000000', 'TRIM_HORIZON', NULL, NULL),
          ('shardId-000000000001', 'AT_SEQUENCE_NUMBER', '500', NULL),
          ('shardId-000000000002', 'AFTER_SEQUENCE_NUMBER', '502', NULL),
          ('shardId-000000000003', 'AT_TIMESTAMP', NULL, '2024-01-16')
          AS t(shard_id, position, sequence_number, at)
        """
    )


def streams(spark: SparkSession) -> DataFrame:
    """A status for each event type."""
    return spark.sql(
        """
        SELECT * FROM VALUES ('signup', 'CREATING'), ('error', 'DELETING'),
          ('click', 'ACTIVE'), ('view', 'UPDATING'), ('purchase', NULL) AS t(stream, status)
        """
    )


def status_history(spark: SparkSession) -> DataFrame:
    """The statuses of the event types over January; ``purchase`` has none."""
    return spark.sql(
        """
        SELECT stream, status, CAST(CAST(at AS TIMESTAMP_NTZ) AS TIMESTAMP) AS at FROM VALUES
          ('signup', 'CREATING', '2024-01-03'), ('signup', 'ACTIVE', '2024-01-05 06:00:00'),
          ('signup', 'DELETING', '2024-01-12'), ('signup', 'ACTIVE', '2024-01-20 12:30:00'),
          ('click', 'ACTIVE', '2023-12-31'), ('view', 'ACTIVE', '2024-01-02'), ('view', NULL, '2024-01-15'),
          ('view', 'UPDATING', '2024-01-25'), ('error', 'CREATING', '2024-01-10') AS t(stream, status, at)
        """
    )


def sent_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Delivery records as put requests of 500, written down as they were sent."""
    return materialised(put_shape(delivery_records(spark, sf), 500), "requests")


def responses(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the service answered: heads and entries.

    Records of type ``error`` fail, some with a code only and some with a text
    only.  Every seventh request has no response, another seventh a response
    without a failed count.
    """
    kind = F.col("request_id") % 7
    failed = value_text().startswith("error")
    code_only = F.col("idx") % 2 == 0
    answered = requests.where(kind != 3)
    entries = answered.select(
        "request_id",
        "idx",
        F.when(failed & code_only, F.lit("InternalFailure")).alias("error_code"),
        F.when(failed & ~code_only, F.concat(F.lit("cannot store record of key "), "partition_key"))
        .otherwise(F.lit(""))
        .alias("error_message"),
    )
    heads = (
        answered.groupBy("request_id")
        .agg(F.count_if(failed).alias("failed_count"))
        .select("request_id", F.when(kind != 5, F.col("failed_count")).alias("failed_count"))
    )
    return heads, entries
