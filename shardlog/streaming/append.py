"""Append a record stream to the log, or its payloads to a keyless sink."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shardlog.sources.files import write_once
from shardlog.sources.log import deliver_payload, payload_lines, write_part
from shardlog.streaming.writers import save_once, write_batches


def append(
    records: DataFrame,
    path: str,
    checkpoint: str,
    partitions: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Start appending to the log and return at once.

    Start it again with the same ``checkpoint`` after a stop: it continues where
    it was, without gaps or copies.  Other streams and batches may append to the
    same log.  Every micro-batch is written in shard order, by ``partitions`` tasks
    if given, so hot shards are split and files have tight bounds.
    """

    def save(batch: DataFrame, writer: str, batch_id: int) -> None:
        write_part(batch, path, writer, batch_id, partitions)

    return write_batches(records, save, checkpoint, trigger)


def append_sync(
    records: DataFrame, path: str, checkpoint: str, partitions: int | None = None
) -> StreamingQuery:
    """Append everything that is there now and return when it is durable."""
    query = append(records, path, checkpoint, partitions, availableNow=True)
    query.awaitTermination()
    return query


def append_payload(
    records: DataFrame,
    path: str,
    checkpoint: str,
    line_sep: str | None = None,
    terminator: bytes = b"",
    **trigger,
) -> StreamingQuery:
    """Keyless sink: text lines when a separator is given, else Parquet bytes.

    See ``sources.log.write_payload`` for the terminator and for payloads that are
    not text.  Several streams may write to one path.
    """

    def save(batch: DataFrame, writer: str, batch_id: int) -> None:
        if line_sep:
            text, odd = payload_lines(batch)
            part = f"writer={writer}/batch_id={batch_id}"
            write_once(batch.sparkSession, path, part, text.write.option("lineSep", line_sep).text)
            save_once(odd, f"{path}-undecodable", writer, batch_id)
        else:
            save_once(deliver_payload(batch, terminator), path, writer, batch_id)

    return write_batches(records, save, checkpoint, trigger)
