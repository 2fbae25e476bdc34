from shardlog.operators.quota import (
    delivery_rate,
    oversized_calls,
    oversized_records,
    oversized_requests,
    read_rate,
    traffic,
    write_bytes,
    write_rate,
)
from tests.util import record, records, requests


def busy(spark):
    """Shard a: 5 records in second 0, 2 in second 1. Shard b: 3 in second 0."""
    rows = [record("a", str(i), "kk", b"12345678", at=i / 10) for i in range(5)]
    rows += [record("a", str(5 + i), None, b"1", at=1 + i / 10) for i in range(2)]
    rows += [record("b", str(i), "", None, at=0.999999) for i in range(3)]
    return records(spark, rows)


def shown(df, *columns):
    return {(r.shard_id, r.window_start.second, *[r[c] for c in columns]) for r in df.collect()}


def test_traffic_per_shard_and_second(spark):
    got = shown(traffic(busy(spark), ["stream", "shard_id"]), "n_records", "n_bytes")
    assert got == {("a", 0, 5, 50), ("a", 1, 2, 2), ("b", 0, 3, 0)}


def test_limits_are_inclusive(spark):
    assert shown(write_rate(busy(spark), limit=3), "n_records") == {("a", 0, 5)}
    assert shown(write_rate(busy(spark), limit=2), "n_records") == {("a", 0, 5), ("b", 0, 3)}
    assert shown(write_bytes(busy(spark), limit=50), "n_bytes") == set()
    assert shown(write_bytes(busy(spark), limit=49), "n_bytes") == {("a", 0, 50)}
    assert write_rate(busy(spark)).isEmpty() and write_bytes(busy(spark)).isEmpty()


def test_read_rate_counts_fetches(spark):
    assert shown(read_rate(busy(spark), per_fetch=2), "n_fetches") == {("a", 0, 3)}
    assert shown(read_rate(busy(spark), per_fetch=2, limit=1), "n_fetches") == {("a", 0, 3), ("b", 0, 2)}
    assert read_rate(busy(spark)).isEmpty()


def test_oversized(spark):
    assert oversized_records(busy(spark), limit=7).count() == 5
    assert oversized_records(busy(spark)).isEmpty()
    sent = [(1, i, "k", b"123456789") for i in range(3)] + [(2, 0, None, b"1" * 40)]
    over = {(r.request_id, r.n_records, r.n_bytes) for r in oversized_requests(requests(spark, sent), 2, 100).collect()}
    assert over == {(1, 3, 30)}
    over = {r.request_id for r in oversized_requests(requests(spark, sent), 500, 39).collect()}
    assert over == {2}
    over = {(r.request_id, r.n_bytes) for r in oversized_calls(requests(spark, sent), 500, 26).collect()}
    assert over == {(1, 27), (2, 40)}


def test_delivery_rate_is_per_stream_without_keys(spark):
    def got(**limits):
        return {
            (r.window_start.second, r.n_records, r.n_bytes, r.n_requests)
            for r in delivery_rate(busy(spark), **limits).collect()
        }

    assert got() == set()
    assert got(max_records=7) == {(0, 8, 40, 8)}
    assert got(max_bytes=39) == {(0, 8, 40, 8)}
    assert got(per_request=500, max_requests=1) == set()
    assert got(per_request=3, max_requests=2) == {(0, 8, 40, 3)}


def test_a_hot_shard_is_combined_before_the_shuffle(spark):
    plan = traffic(busy(spark), ["stream", "shard_id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_sum" in plan
