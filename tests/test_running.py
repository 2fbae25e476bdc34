"""Operators on running values against plain loops over each shard."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlog.operators import pacing, quota, requests, status
from shardlog.operators.numbering import Numbering
from shardlog.operators.running import LAST, MAX, SUM, running_over
from shardlog.schema import RECORD, SEQUENCE_ORDER, SHARD_KEYS
from tests.util import T0, record

NULLABLE = T.StructType([T.StructField(f.name, f.dataType) for f in RECORD])


@pytest.fixture
def spread(spark):
    """Many range partitions, which are not put together again."""
    for key, value in (("spark.sql.adaptive.coalescePartitions.enabled", "false"), ("spark.sql.shuffle.partitions", "13")):
        spark.conf.set(key, value)
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def made(seed, n=400, shards=("hot", "hot", "hot", "b", None), spread_over=60):
    """Records whose times tie now and then; one shard holds most of them, some have no time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = rng.randrange(spread_over * 4) / 4
        row = list(record(rng.choice(shards), str(i), rng.choice(["k", None, "key"]), bytes(rng.choice([0, 1, 30, 200])), at))
        if rng.random() < 0.03:
            row[6] = None
        rows.append(tuple(row))
    return rows


def per_shard(rows):
    shards = {}
    for r in rows:
        shards.setdefault(r[1], []).append(r)
    return shards


def test_running_values(spread):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 5 + ["a", None]), i, rng.choice([None, rng.randrange(100)])) for i in range(900)]
    df = spread.createDataFrame(rows, "g string, i int, v int").repartition(7)
    got = running_over(df, ["g"], ["i"], {"s": (SUM, F.col("v")), "m": (MAX, F.col("v")), "l": (LAST, F.col("v"))})
    want = Counter()
    for g in {r[0] for r in rows}:
        s, m, last = 0, None, None
        for _, i, v in sorted(r for r in rows if r[0] == g):
            if v is not None:
                s, m, last = s + v, max(v, -1 if m is None else m), v
            want[g, i, v, s, m, last] += 1
    assert Counter(map(tuple, got.collect())) == want


def test_a_hot_group_is_spread_over_tasks(spread):
    df = spread.range(20_000).select(F.lit("hot").alias("g"), "id")
    parts = Numbering(df, ["g"], ["id"]).placed().groupBy("_part").count().collect()
    assert len(parts) > 5 and max(r["count"] for r in parts) < 6_000


@pytest.mark.parametrize("limit", [1, 3, 50])
def test_write_schedule(spread, limit):
    rows = made(limit)
    period = 2_000_000
    sent = pacing.with_backlog(pacing.write_schedule(spread.createDataFrame(rows, NULLABLE), limit, period))
    want = Counter()
    for shard, own in per_shard(rows).items():
        gone = []
        for r in sorted((r for r in own if r[6]), key=lambda r: (r[6], len(r[2]), r[2])):
            at = max(r[6], gone[-limit] + dt.timedelta(microseconds=period)) if len(gone) >= limit else r[6]
            want[shard, r[2], at, sum(d > r[6] for d in gone)] += 1
            gone.append(at)
        want.update((shard, r[2], None, None) for r in own if not r[6])
    assert Counter((r.shard_id, r.sequence_number, r.send_ts, r.waiting) for r in sent.collect()) == want
    assert sent.columns == [*RECORD.names, "send_ts", "waiting"]
    # No window holds more than the limit, which the peaks confirm.
    out = sent.drop("arrival_ts").withColumnRenamed("send_ts", "arrival_ts")
    assert quota.write_peak(out, limit, 1 << 40, period).where("exceeded").isEmpty()


def test_schedules_of_nothing(spark):
    empty = spark.createDataFrame([], NULLABLE)
    assert pacing.with_backlog(pacing.write_schedule(empty)).isEmpty() and pacing.read_schedule(empty).isEmpty()
    assert quota.write_peak(empty).isEmpty() and requests.put_shape_bytes(empty).isEmpty()
    with pytest.raises(ValueError, match="greater than zero"):
        pacing.write_schedule(empty, 0)


def test_read_schedule(spread):
    rows = [r for r in made(7) if r[6]]
    got = pacing.read_schedule(spread.createDataFrame(rows, NULLABLE), per_fetch=4, limit=2, period=1_500_000)
    want = set()
    for shard, own in per_shard(rows).items():
        own.sort(key=lambda r: (len(r[2]), r[2]))
        ready, gone = dt.datetime.min, []
        for no in range(-(-len(own) // 4)):
            some = own[4 * no : 4 * no + 4]
            ready = max(ready, *(r[6] for r in some))
            gone.append(max(ready, gone[-2] + dt.timedelta(seconds=1.5)) if no >= 2 else ready)
            want.add((shard, no, len(some), ready, gone[-1]))
    assert {(r.shard_id, r.fetch_no, r.n_records, r.ready_ts, r.fetch_ts) for r in got.collect()} == want


@pytest.mark.parametrize("period", [1_000_000, 3_250_000])
def test_peaks(spread, period):
    rows = made(5)
    got = quota.write_peak(spread.createDataFrame(rows, NULLABLE), 8, 900, period)
    want = set()
    for shard, own in per_shard(rows).items():
        ends = {}
        for end in sorted({r[6] for r in own if r[6]}):
            held = [r for r in own if r[6] and end - dt.timedelta(microseconds=period) < r[6] <= end]
            ends[end] = len(held), sum(len(r[5]) + len(r[4] or "") for r in held)
        n, b = (max(x[k] for x in ends.values()) for k in (0, 1))
        first = lambda k, most: min(e for e, x in ends.items() if x[k] == most)  # noqa: E731, B023
        want.add((shard, n, first(0, n), b, first(1, b), n > 8 or b > 900))
    assert {tuple(r[1:]) for r in got.collect()} == want


def greedy(own, per_request, max_bytes):
    """Requests of one shard, one record after the other."""
    made_, held = [], 0
    for r in own:
        size = len(r[5] or b"") + len(r[4] or "")
        if not made_ or len(made_[-1]) == per_request or held + size > max_bytes:
            made_.append([])
            held = 0
        made_[-1].append(r)
        held += size
    return made_


@pytest.mark.parametrize("per_request,max_bytes,block,fanout", [(5, 400, 5, 2), (5, 400, 7, 3), (1, 10, 4, 2), (20, 150, 20, 4), (500, 1 << 20, 1 << 16, 256), (7, 0, 8, 5)])
def test_requests_within_two_limits(spread, per_request, max_bytes, block, fanout):
    rows = made(per_request, 600)
    rows += [record("tiny", "1", None, None), record("big", "1", "k", bytes(5000)), record("big", "2", "k", b"x"), record("big", "3", "k", bytes(5000))]
    got = requests.put_shape_bytes(spread.createDataFrame(rows, NULLABLE), per_request, max_bytes, block=block, fanout=fanout)
    want, no = [], 0
    for _, own in sorted(per_shard(rows).items(), key=lambda x: (x[0] is not None, x[0] or "")):
        own.sort(key=lambda r: (len(r[2]), r[2]))
        for request in greedy(own, per_request, max_bytes):
            want += [("s", no, idx, r[4] or "", r[5]) for idx, r in enumerate(request)]
            no += 1
    assert Counter((r.stream, r.request_id, r.idx, r.partition_key, r.data and bytes(r.data)) for r in got.collect()) == Counter(
        (s, n, i, k, d and bytes(d)) for s, n, i, k, d in want
    )
    over = quota.oversized_requests(got, per_request, max_bytes).collect()
    assert all(r.n_records == 1 for r in over)


def test_requests_of_one_hot_shard_are_cut_by_many_tasks(spread):
    n = 30_000
    rows = spread.range(n).select(
        F.lit("s").alias("stream"), F.lit("hot").alias("shard_id"), F.col("id").cast("string").alias("sequence_number"),
        F.length(F.col("id").cast("string")).alias("sequence_len"), F.lit("k").alias("partition_key"),
        F.repeat(F.lit("x"), (F.col("id") * 7919 % 50).cast("int")).cast("binary").alias("data"),
    )
    numbered = Numbering(rows.withColumn("_size", quota.put_bytes()), SHARD_KEYS, SEQUENCE_ORDER).rows("_row")
    cuts = requests.Cuts(numbered, 40, 900, 1000, 4)
    blocks = cuts.rows.groupBy("_block").count().collect()
    assert len(blocks) == 30 and max(r["count"] for r in blocks) == 1039
    found = {r._row: (r._no, r.idx) for r in cuts.assigned().collect()}
    no, idx, held = 0, -1, 0
    for i in range(n):
        size = i * 7919 % 50 + 1
        no, idx, held = (no + 1, 0, size) if idx == 39 or held + size > 900 else (no, idx + 1, held + size)
        assert found[i] == (no, idx)


def test_status_at_arrival(spread):
    rows = [record("0", str(i), at=i, stream=s) for i in range(100) for s in ("a", "b", "none")]
    rows += [(None, "0", "1", 1, "k", b"", T0), ("a", "0", "x", 1, "k", b"", None)]
    on = [("a", "CREATING", 10), ("a", "ACTIVE", 20), ("a", "DELETING", 50), ("a", "ACTIVE", 70), ("a", None, 90), ("b", "ACTIVE", 30)]
    on += [("b", "UPDATING", 40), ("b", "ACTIVE", 40), ("c", "ACTIVE", 0)]  # of one moment the greatest name
    history = [(s, name, T0 + dt.timedelta(seconds=at)) for s, name, at in on] + [("none", "ACTIVE", None)]
    df = spread.createDataFrame(rows, NULLABLE)
    history = spread.createDataFrame(history, "stream string, status string, at timestamp")
    kept = status.active_at_arrival(df, history)
    assert kept.columns == df.columns
    want = {("a", str(i)) for i in range(100) if 20 <= i < 50 or 70 <= i < 90} | {("b", str(i)) for i in range(30, 40)}
    assert {(r.stream, r.sequence_number) for r in kept.collect()} == want
    reasons = Counter(r.reason for r in status.rejected_at_arrival(df, history).collect())
    # b is being updated from 40 on, a is created and deleted for 40 seconds
    assert reasons == {"The Stream is not known": 10 + 30 + 100 + 2, "Nil stream status": 10, "The Stream is not yet active": 10 + 20 + 60}
