from pyspark.sql import functions as F

from shardlog.operators.consume import error_counts
from shardlog.operators.delivery import (
    delivery_counts,
    delivery_counts_keyless,
    delivery_errors,
    reconcile,
    retry_keyless,
    retry_set,
)
from tests.util import entries, heads, requests

# Request 1: mixed. 2: no response. 3: failed count 0, yet an error code.
# 4: failed count null. 5: all good. 6: short response. 7: null and empty errors only.
SENT = [
    (request, idx, f"k{request}", f"{request}.{idx}".encode())
    for request, size in [(1, 4), (2, 2), (3, 1), (4, 1), (5, 2), (6, 2), (7, 2)]
    for idx in range(size)
]
HEADS = [(1, 2), (3, 0), (4, None), (5, 0), (6, 1), (7, 1)]
ENTRIES = [
    (1, 0, None, None),
    (1, 1, "Throttled", None),
    (1, 2, "", "slow down"),
    (1, 3, "", ""),
    (3, 0, "Odd", "not looked at"),
    (4, 0, "Odd", "not looked at"),
    (5, 0, None, None),
    (5, 1, None, None),
    (6, 0, "Throttled", "busy"),
    (7, 0, None, ""),
    (7, 1, "", None),
]


def outcomes(spark):
    return reconcile(requests(spark, SENT), heads(spark, HEADS), entries(spark, ENTRIES))


def test_reconcile_by_position(spark):
    rows = {(r.request_id, r.idx): r for r in outcomes(spark).collect()}
    assert len(rows) == len(SENT)
    assert {k for k, r in rows.items() if r.failed} == {(1, 1), (1, 2), (6, 0)}
    assert {k for k, r in rows.items() if not r.answered} == {(2, 0), (2, 1)}
    assert (rows[1, 1].error_code, rows[1, 1].error_message) == ("Throttled", "")
    assert (rows[1, 2].error_code, rows[1, 2].error_message) == ("", "slow down")
    assert rows[3, 0].error_code is None


def test_retry_set_keeps_payload_and_key(spark):
    again = {(r.partition_key, bytes(r.data)) for r in retry_set(outcomes(spark)).collect()}
    assert again == {
        ("k1", b"1.1"),
        ("k1", b"1.2"),
        ("k2", b"2.0"),
        ("k2", b"2.1"),
        ("k6", b"6.0"),
    }
    keyless = retry_keyless(outcomes(spark))
    assert {r.partition_key for r in keyless.collect()} == {""}
    assert keyless.count() == 5


def test_counts(spark):
    keyed = delivery_counts(outcomes(spark)).first()
    assert (keyed.n_messages, keyed.n_delivered) == (len(SENT) - 3, len(SENT) - 5)
    keyless = delivery_counts_keyless(
        requests(spark, SENT), heads(spark, HEADS), entries(spark, ENTRIES)
    ).first()
    # 1: two of four; 3, 4, 5: all entries; 6: none of one entry; 7: both.
    assert keyless.n_messages == 2 + 1 + 1 + 2 + 0 + 2


def test_hundred_single_sends_count_hundred(spark):
    sent = [(n, 0, "", b"this is a message") for n in range(100)]
    answered = heads(spark, [(n, None) for n in range(100)])
    replies = entries(spark, [(n, 0, None, None) for n in range(100)])
    assert delivery_counts_keyless(requests(spark, sent), answered, replies).first().n_messages == 100
    assert retry_set(reconcile(requests(spark, sent), answered, replies)).isEmpty()


def test_stream_without_any_response_counts_zero(spark):
    none = delivery_counts_keyless(requests(spark, SENT), heads(spark, []), entries(spark, []))
    assert none.first().n_messages == 0


def test_error_counts(spark):
    counted = error_counts(delivery_errors(outcomes(spark)))
    got = {(r.stream, r.error_message): r.n_errors for r in counted.collect()}
    assert got == {("s", ""): 1, ("s", "slow down"): 1, ("s", "busy"): 1}


def test_one_request_id_may_hold_most_records(spark):
    hot = spark.range(3000).select(
        F.lit("s").alias("stream"),
        F.lit(1).cast("long").alias("request_id"),
        F.col("id").cast("int").alias("idx"),
        F.lit("k").alias("partition_key"),
        F.encode(F.col("id").cast("string"), "UTF-8").alias("data"),
    )
    replies = hot.select(
        "request_id",
        "idx",
        F.when(F.col("idx") % 3 == 0, F.lit("E")).alias("error_code"),
        F.lit("").alias("error_message"),
    )
    done = reconcile(hot, heads(spark, [(1, 1000)]), replies)
    assert done.where("failed").count() == 1000 and done.count() == 3000


def test_payload_is_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = reconcile(requests(spark, SENT), heads(spark, HEADS), entries(spark, ENTRIES))
        plan = done._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert sum("hashpartitioning(request_id" in line for line in exchanges) >= 2
    sent = plan[: plan.index("Scan ExistingRDD")]
    assert sent.count("Exchange") == 1
