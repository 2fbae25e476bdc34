"""Run user functions on payloads, with errors as a side output, and count."""

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shardlog.operators.fetch import retrieve
from shardlog.schema import SHARD_KEYS, require_concurrency


def for_each_message(
    records: DataFrame,
    fn: Callable[[bytes], object],
    result_type: str | T.DataType,
    concurrency: int | None = None,
) -> DataFrame:
    """Call ``fn`` with each payload; it gets the value only, not the key.

    A call that raises, or returns what is not of ``result_type``, does not stop the others: its row has the text of the
    exception in ``error_message`` and a null ``value``.  Without ``concurrency``
    the input's own partitions run in parallel; with it, records are dealt out
    evenly over that many tasks, whatever their shard.
    """
    if concurrency is not None:
        require_concurrency(concurrency)
        records = records.repartition(concurrency)
    if isinstance(result_type, str):
        result_type = T.DataType.fromDDL(result_type)
    ident = [*SHARD_KEYS, "sequence_number"]
    schema = T.StructType(
        [records.schema[c] for c in ident]
        + [T.StructField("value", result_type), T.StructField("error_message", T.StringType())]
    )

    kind = to_arrow_type(result_type)

    def call(payload):
        try:
            value = fn(payload)
            pa.scalar(value, kind)  # a result of another type is an error of the call
            return value, None
        except Exception as error:  # any failure of user code is data here
            return None, str(error) or type(error).__name__

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            outcome = [call(payload) for payload in batch["data"]]
            done = batch[ident].copy()
            done["value"] = pd.Series([o[0] for o in outcome], index=done.index, dtype=object)
            done["error_message"] = pd.Series([o[1] for o in outcome], index=done.index, dtype=object)
            yield done

    return records.select(*ident, "data").mapInPandas(run, schema)


def retrieve_fn(
    records: DataFrame, fn: Callable[[bytes], object], result_type: str | T.DataType
) -> DataFrame:
    """Take the next message of every shard and call ``fn`` on it."""
    return for_each_message(retrieve(records), fn, result_type)


def split_errors(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and error rows of ``for_each_message``.

    Both are filters over the same input: write ``outcomes`` to a table first if
    the user function must not run once per output.
    """
    failed = F.col("error_message").isNotNull()
    good = outcomes.where(~failed).drop("error_message")
    errors = outcomes.where(failed).select(*SHARD_KEYS, "sequence_number", "error_message")
    return good, errors


def message_counts(records: DataFrame) -> DataFrame:
    return records.groupBy(*SHARD_KEYS).agg(F.count(F.lit(1)).alias("n_messages"))


def error_counts(errors: DataFrame) -> DataFrame:
    return errors.groupBy("stream", "error_message").agg(F.count(F.lit(1)).alias("n_errors"))


def observe_messages(records: DataFrame, to: str | Observation = "progress") -> DataFrame:
    """Count records while they pass, without a pass of their own.

    Give an ``Observation`` for a batch, a name for a stream; a stream reports the
    count of each micro-batch in its progress.  ``streaming.progress`` adds them up
    while they pass; ``streaming.listen.handled_counts`` counts what ``listen`` stored.
    """
    return records.observe(to, F.count(F.lit(1)).alias("n_messages"))
