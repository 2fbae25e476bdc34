"""Schemas of the record-stream tables and the fixed values that go with them."""

from pyspark.sql import types as T

SHARD_KEYS = ["stream", "shard_id"]
SEQUENCE_ORDER = ["sequence_len", "sequence_number"]
SHARD_GROUP = "shard_group"  # the folder of a stored log in which a shard's records lie
SHARD_GROUPS = 64

RECORD = T.StructType(
    [
        T.StructField("stream", T.StringType(), False),
        T.StructField("shard_id", T.StringType(), False),
        T.StructField("sequence_number", T.StringType()),
        T.StructField("sequence_len", T.IntegerType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("data", T.BinaryType()),
        T.StructField("arrival_ts", T.TimestampType()),
    ]
)

POSITION = T.StructType(
    [
        T.StructField("stream", T.StringType(), False),
        T.StructField("shard_id", T.StringType(), False),
        T.StructField("position", T.StringType(), False),
        T.StructField("sequence_number", T.StringType()),
        T.StructField("at_ts", T.TimestampType()),
    ]
)

STREAM = T.StructType(
    [
        T.StructField("stream", T.StringType(), False),
        T.StructField("status", T.StringType()),
    ]
)

CHECKPOINT = T.StructType(
    [
        T.StructField("stream", T.StringType(), False),
        T.StructField("shard_id", T.StringType(), False),
        T.StructField("sequence_number", T.StringType()),
        T.StructField("sequence_len", T.IntegerType()),
    ]
)

REQUEST = T.StructType(
    [
        T.StructField("stream", T.StringType(), False),
        T.StructField("request_id", T.LongType(), False),
        T.StructField("idx", T.IntegerType(), False),
        T.StructField("partition_key", T.StringType()),
        T.StructField("data", T.BinaryType()),
    ]
)

RESPONSE_HEAD = T.StructType(
    [
        T.StructField("request_id", T.LongType(), False),
        T.StructField("failed_count", T.LongType()),
    ]
)

RESPONSE_ENTRY = T.StructType(
    [
        T.StructField("request_id", T.LongType(), False),
        T.StructField("idx", T.IntegerType(), False),
        T.StructField("error_code", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

ERROR = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("sequence_number", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

# Start position names and their integer codes.
AT_SEQUENCE_NUMBER = "AT_SEQUENCE_NUMBER"
AFTER_SEQUENCE_NUMBER = "AFTER_SEQUENCE_NUMBER"
TRIM_HORIZON = "TRIM_HORIZON"
LATEST = "LATEST"
AT_TIMESTAMP = "AT_TIMESTAMP"
POSITION_CODES = {
    0: AT_SEQUENCE_NUMBER,
    1: AFTER_SEQUENCE_NUMBER,
    2: TRIM_HORIZON,
    3: LATEST,
}

# Stream status names and their integer codes.
ACTIVE = "ACTIVE"
STATUS_CODES = {4: "CREATING", 5: "DELETING", 6: ACTIVE, 7: "UPDATING"}

# Error texts.
ERR_NULL_STREAM = "A stream must be specified"
ERR_NOT_ACTIVE = "The Stream is not yet active"
ERR_NIL_STATUS = "Nil stream status"
ERR_UNKNOWN_STREAM = "The Stream is not known"
ERR_BAD_CONCURRENCY = "Concurrency must be greater than zero"
ERR_DROPPED = "Channel is full, dropped message"

# Quotas, per shard for the keyed service, per stream for the keyless one.
RECORDS_PER_FETCH = 10_000
FETCHES_PER_SECOND = 2
WRITES_PER_SECOND = 1_000
WRITE_BYTES_PER_SECOND = 1_048_576
MAX_RECORD_BYTES = 1_048_576
MAX_REQUEST_RECORDS = 500
MAX_REQUEST_BYTES = 5 * 1_048_576
DELIVERY_REQUESTS_PER_SECOND = 2_000
DELIVERY_RECORDS_PER_SECOND = 5_000
DELIVERY_BYTES_PER_SECOND = 5 * 1_048_576
MAX_DELIVERY_CALL_BYTES = 4 * 1_048_576
BUFFER_PER_WORKER = 1_000


def require_stream(stream: str | None) -> None:
    if not stream:
        raise ValueError(ERR_NULL_STREAM)


def require_concurrency(concurrency: int) -> None:
    if concurrency < 1:
        raise ValueError(ERR_BAD_CONCURRENCY)
