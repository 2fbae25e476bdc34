"""Reading in fetches, and taking single messages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardlog.functions.sequence import is_numbered, number_key
from shardlog.operators.lookup import lookup
from shardlog.operators.numbering import number_rows
from shardlog.schema import RECORDS_PER_FETCH, SEQUENCE_ORDER, SHARD_KEYS


def fetch_batches(records: DataFrame, per_fetch: int = RECORDS_PER_FETCH) -> DataFrame:
    """Number the fetch that returns each record, at most ``per_fetch`` records each."""
    numbered = number_rows(records, SHARD_KEYS, SEQUENCE_ORDER, "_row")
    return numbered.withColumn("fetch_no", F.floor(F.col("_row") / per_fetch)).drop("_row")


def retrieve(records: DataFrame) -> DataFrame:
    """The next message of every shard; records without a number are never next.

    The least number per shard is found on key columns alone, then its record is
    taken.  Of copies of that record one is returned.
    """
    sequenced = records.where(is_numbered())
    least = sequenced.groupBy(*SHARD_KEYS).agg(F.min(number_key()).alias("least"))
    least = least.select(*SHARD_KEYS, F.col("least.number").alias("sequence_number"))
    found = lookup(sequenced, least, [*SHARD_KEYS, "sequence_number"])
    return found.select(*records.columns).dropDuplicates(SHARD_KEYS)


def retrieve_or_error(records: DataFrame, errors: DataFrame) -> DataFrame:
    """The next message or the next error of every shard, whichever comes first.

    ``errors`` has the shard, a ``sequence_number`` and an ``error_message``.  An
    error row keeps these and has no payload.  Errors without a number come
    before everything else, and an error before the message of its own number.
    """
    messages = retrieve(records).withColumn("error_message", F.lit(None).cast("string"))
    known = errors.select(*SHARD_KEYS, "sequence_number", "error_message")
    both = messages.unionByName(known, allowMissingColumns=True)
    first = F.struct(is_numbered(), number_key(), F.col("error_message").isNull())
    # At most one message per shard is left, so few rows are sorted here.
    rest = [c for c in both.columns if c not in SHARD_KEYS]
    return (
        both.groupBy(*SHARD_KEYS)
        .agg(F.min_by(F.struct(*rest), first).alias("next"))
        .select(*SHARD_KEYS, "next.*")
    )
