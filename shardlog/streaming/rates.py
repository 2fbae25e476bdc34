"""Traffic per window from a stream, without dropping late records.

A watermark would drop what arrives late.  Instead each micro-batch writes its
own partial counts under its batch id, and the reader adds them up: the stream
keeps no state, and a batch that runs twice counts once.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shardlog.operators.quota import SECOND, traffic
from shardlog.schema import SHARD_KEYS
from shardlog.streaming.writers import save_once, write_batches

_PARTIAL = (
    "stream string, shard_id string, window_start timestamp, "
    "n_records bigint, n_bytes bigint"
)


def collect_traffic(
    records: DataFrame, path: str, checkpoint: str, every: str = SECOND, **trigger
) -> StreamingQuery:
    def save(batch: DataFrame, writer: str, batch_id: int) -> None:
        save_once(traffic(batch, SHARD_KEYS, every), path, writer, batch_id)

    return write_batches(records, save, checkpoint, trigger or {"processingTime": "1 second"})


def read_traffic(spark: SparkSession, path: str) -> DataFrame:
    """Whole counts per shard and window over all micro-batches so far."""
    partial = spark.read.schema(_PARTIAL).parquet(path)
    return partial.groupBy(*SHARD_KEYS, "window_start").agg(
        F.sum("n_records").alias("n_records"), F.sum("n_bytes").alias("n_bytes")
    )
