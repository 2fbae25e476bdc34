"""Counts of messages while they pass, without reading results."""

import json
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from shardlog.operators.consume import observe_messages
from shardlog.sources.files import read_text, write_text

EVERY = 100  # messages between two progress lines


class MessageProgress(StreamingQueryListener):
    """Adds up the messages of every micro-batch of one stream, over its restarts.

    The stream passes through ``counted``; Spark reports the count of each micro-batch with
    its progress.  The total is kept in a small file next to the stream's checkpoint, with
    the last micro-batch that it holds, so a report that comes twice counts once.  ``tell``
    gets the total whenever it has passed another ``every`` messages.  Reports arrive after
    their micro-batch; one whose driver dies in between is not counted.
    """

    def __init__(self, spark: SparkSession, checkpoint: str, every: int = EVERY, tell: Callable[[int], None] | None = None):
        self.spark, self.path, self.every = spark, f"{checkpoint}/messages", every
        self.name = f"messages {checkpoint}"
        self.tell = tell or (lambda n: logging.getLogger(__name__).info("messages handled so far: %s", n))
        saved = read_text(spark, self.path)
        self.total, self.batch = (0, -1) if saved is None else json.loads(saved)

    def counted(self, records: DataFrame) -> DataFrame:
        """``records``, whose count Spark reports under a name that belongs to this stream."""
        return observe_messages(records, self.name)

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is None or event.progress.batchId <= self.batch:
            return
        before, self.batch = self.total, event.progress.batchId
        self.total += found["n_messages"] or 0
        write_text(self.spark, self.path, json.dumps([self.total, self.batch]))
        if self.total // self.every > before // self.every:
            self.tell(self.total)

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        """Wait for the reports that are under way, then stop listening."""
        self.spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
