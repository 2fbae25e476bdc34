"""Match responses to sent records, collect what must be sent again, count."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_error() -> Column:
    """An entry failed iff its code or its message is non-empty (null counts as empty)."""
    return (F.coalesce("error_code", F.lit("")) != "") | (
        F.coalesce("error_message", F.lit("")) != ""
    )


def reconcile(requests: DataFrame, heads: DataFrame, entries: DataFrame) -> DataFrame:
    """Outcome of every sent record, matched to the response entry at its position.

    ``answered``: the request has a response.  ``failed``: the response counts
    failures and the entry carries an error; entries are not looked at when the
    failed count is zero or null.  A response becomes one row that holds its few
    errors by position (a request has a bounded number of entries), so the sent
    payloads are shuffled once at most.
    """
    errors = (
        entries.where(has_error() & F.col("idx").isNotNull())
        .groupBy("request_id", "idx")
        .agg(F.first(F.struct("error_code", "error_message")).alias("error"))
        .groupBy("request_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("idx", "error"))).alias("_errors"))
    )
    failures = F.coalesce("failed_count", F.lit(0)).alias("_failures")
    answers = heads.select("request_id", failures).join(errors, "request_id", "left")
    matched = requests.join(answers, "request_id", "left")
    error = F.element_at("_errors", F.col("idx"))
    failed = F.coalesce((F.col("_failures") > 0) & error.isNotNull(), F.lit(False))
    return matched.select(
        *requests.columns,
        F.col("_failures").isNotNull().alias("answered"),
        failed.alias("failed"),
        *[
            F.when(failed, F.coalesce(error[c], F.lit(""))).alias(c)
            for c in ("error_code", "error_message")
        ],
    )


def retry_set(outcomes: DataFrame) -> DataFrame:
    """What must be sent again: failed records and all records of unanswered requests.

    Only payload and key survive.
    """
    again = F.col("failed") | ~F.col("answered")
    return outcomes.where(again).select("stream", "partition_key", "data")


def retry_keyless(outcomes: DataFrame) -> DataFrame:
    """The keyless service's retry set: the key is lost as well."""
    return retry_set(outcomes).withColumn("partition_key", F.lit(""))


def delivery_errors(outcomes: DataFrame) -> DataFrame:
    """Every error of a delivery, for ``error_counts``: refused entries and sends that broke off."""
    told = F.col("error_message").isNotNull()
    return outcomes.where(told).select("stream", "error_message")


def delivery_counts(outcomes: DataFrame) -> DataFrame:
    """Keyed rule: one up when a record is sent, one down when its entry failed.

    Records of unanswered requests are not taken back by this rule and count once
    more when they are sent again; ``n_delivered`` leaves them out.
    """
    return outcomes.groupBy("stream").agg(
        (F.count(F.lit(1)) - F.count_if("failed")).alias("n_messages"),
        F.count_if(F.col("answered") & ~F.col("failed")).alias("n_delivered"),
    )


def delivery_counts_keyless(
    requests: DataFrame, heads: DataFrame, entries: DataFrame
) -> DataFrame:
    """Keyless rule: successes only, and all entries of a response without failures."""
    failures = F.coalesce("failed_count", F.lit(0)) > 0
    per_request = (
        heads.join(entries, "request_id")
        .groupBy("request_id")
        .agg(F.count_if(~(failures & has_error())).alias("_delivered"))
    )
    owner = requests.select("request_id", "stream").distinct()
    return (
        owner.join(per_request, "request_id", "left")
        .groupBy("stream")
        .agg(F.coalesce(F.sum("_delivered"), F.lit(0)).alias("n_messages"))
    )
