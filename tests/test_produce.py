import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shardlog.operators.fetch import fetch_batches, retrieve, retrieve_or_error
from shardlog.operators.lookup import lookup
from shardlog.operators.numbering import Numbering, number_rows
from shardlog.operators.produce import admit, put_shape
from shardlog.schema import SEQUENCE_ORDER, SHARD_KEYS
from tests.util import BIG, numbers, plan_of, record, records


def skewed(spark, n=6000):
    """Half of all records in one shard, the others in a few small ones."""
    number = (F.col("id") * 7 + 3).cast("string")
    shard = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") % 5).cast("string"))
    return spark.range(n).select(
        F.lit("s").alias("stream"),
        shard.alias("shard_id"),
        number.alias("sequence_number"),
        F.length(number).alias("sequence_len"),
        F.lit("k").alias("partition_key"),
        F.encode(number, "UTF-8").alias("data"),
        F.timestamp_seconds("id").alias("arrival_ts"),
    )


def by_window(df, keys, order):
    return df.withColumn("row_no", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") - 1)


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_numbers_are_those_of_a_window(spark):
    same(number_rows(skewed(spark), SHARD_KEYS, SEQUENCE_ORDER), by_window(skewed(spark), SHARD_KEYS, SEQUENCE_ORDER))
    assert number_rows(skewed(spark, 0), SHARD_KEYS, SEQUENCE_ORDER).count() == 0


def test_any_type_orders_and_null_groups_are_numbered(spark):
    """Negative and missing numbers, times before 1970, letters of several bytes, null groups."""
    rows = []
    for n in range(1200):
        number = None if n % 50 == 0 else (n * 7919 % 601) - 300
        name = ["", "a", "ab", "é", "z\0", "日", "\U0001f600"][n % 7] + str(n)
        rows.append((None if n % 5 == 0 else "s", f"shard {n % 3} é", number, name, (n * 31 % 997) - 500))
    schema = "stream string, shard_id string, number int, name string, second long"
    table = spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_seconds("second"))
    table = table.withColumn("ntz", F.col("at").cast("timestamp_ntz")).withColumn("x", F.col("number") / 7)
    for order in (["number", "name"], ["at", "number", "name"], ["name"], ["ntz", "name"], ["x", "name"]):
        same(number_rows(table, SHARD_KEYS, order), by_window(table, SHARD_KEYS, order))


def test_equal_rows_of_one_group_are_split_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    numbering = Numbering(skewed(spark, 40_000).withColumn("hour", F.lit(1)), ["stream"], ["hour"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = numbering._rows.groupBy("_part").count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 20_000
    got = numbering.rows("n").select("n").collect()
    assert sorted(r.n for r in got) == list(range(40_000))


def test_fetches_hold_at_most_the_limit_in_order(spark):
    fetched = fetch_batches(skewed(spark), 700)
    rows = (
        fetched.groupBy("shard_id", "fetch_no")
        .agg(F.count("*").alias("n"), F.min("arrival_ts").alias("lo"), F.max("arrival_ts").alias("hi"))
        .orderBy("shard_id", "fetch_no")
        .collect()
    )
    assert max(r.n for r in rows) == 700
    sizes = {}
    for before, after in zip(rows, rows[1:]):
        if before.shard_id == after.shard_id:
            assert before.hi < after.lo and before.n == 700
    for r in rows:
        sizes[r.shard_id] = sizes.get(r.shard_id, 0) + r.n
    assert sum(sizes.values()) == 6000
    hot = [r.fetch_no for r in rows if r.shard_id == "hot"]
    assert hot == list(range(math.ceil(3000 / 700)))


def offers(spark, n):
    """Two-byte little-endian numbers, offered in order, as one shard."""
    return spark.createDataFrame(
        [record("0", str(i), key="foo", data=i.to_bytes(2, "little")) for i in range(n)],
        records(spark, []).schema,
    )


def test_full_buffer_drops_the_newest(spark):
    marked = admit(offers(spark, 5000), concurrency=4)
    counts = {r.accepted: r["count"] for r in marked.groupBy("accepted").count().collect()}
    assert counts == {True: 4000, False: 1000}
    dropped = marked.where(~F.col("accepted"))
    values = sorted(int.from_bytes(r.data, "little") for r in dropped.collect())
    assert values == list(range(4000, 5000))
    assert {r.reason for r in dropped.collect()} == {"Channel is full, dropped message"}
    assert marked.where("accepted and reason is not null").isEmpty()


def test_short_shards_are_accepted_whole(spark):
    marked = admit(offers(spark, 1000), concurrency=1)
    assert marked.where("accepted").count() == 1000
    assert admit(offers(spark, 0), concurrency=1).count() == 0


def test_equal_offers_across_the_cut_keep_exactly_the_capacity(spark):
    rows = [record("0", "5") for _ in range(1500)] + [record("1", str(i)) for i in range(20)]
    marked = admit(records(spark, rows), concurrency=1)
    counts = {
        (r.shard_id, r.accepted): r["count"]
        for r in marked.groupBy("shard_id", "accepted").count().collect()
    }
    assert counts == {("0", True): 1000, ("0", False): 500, ("1", True): 20}


def test_concurrency_must_be_positive(spark):
    with pytest.raises(ValueError, match="Concurrency must be greater than zero"):
        admit(offers(spark, 1), concurrency=0)


def test_put_requests(spark):
    shaped = put_shape(skewed(spark), 250)
    rows = shaped.groupBy("request_id").agg(
        F.count("*").alias("n"), F.max("idx").alias("last"), F.countDistinct("idx").alias("d")
    ).collect()
    assert sorted(r.request_id for r in rows) == list(range(len(rows)))
    assert all(r.n == r.d == r.last + 1 <= 250 for r in rows)
    assert shaped.count() == 6000
    assert shaped.columns == ["stream", "request_id", "idx", "partition_key", "data"]


def test_requests_of_one_record_and_null_keys(spark):
    shaped = put_shape(records(spark, [record("a", "1", key=None), record("a", "2", key="")]), 1)
    rows = sorted((r.request_id, r.idx, r.partition_key) for r in shaped.collect())
    assert rows == [(0, 0, ""), (1, 0, "")]


def test_retrieve_takes_the_next_of_every_shard(spark):
    rows = [record("a", n, data=n.encode()) for n in ["10", "9", BIG]] + [record("b", BIG)]
    got = retrieve(records(spark, rows))
    assert numbers(got) == [("a", "9"), ("b", BIG)]
    assert got.where("shard_id = 'a'").first().data == b"9"
    assert retrieve(records(spark, [])).count() == 0


def test_retrieve_is_not_hidden_by_records_without_a_number(spark):
    rows = records(spark, [record("a", "6"), record("a", "5"), record("a", "5"), record("a", None), record("a", ""), record("b", None)])
    assert numbers(retrieve(rows)) == [("a", "5")]
    lengths = rows.withColumn("sequence_len", F.lit(None).cast("int"))
    assert numbers(retrieve(lengths)) == [("a", "5")]


def test_next_message_or_error(spark):
    rows = records(spark, [record("a", "6"), record("b", "10"), record("c", "3")])
    errors = spark.createDataFrame(
        [("s", "a", "5", "early"), ("s", "b", "11", "late"), ("s", "c", None, "at once"), ("s", "d", "1", "alone")],
        "stream string, shard_id string, sequence_number string, error_message string",
    )
    got = {r.shard_id: (r.sequence_number, r.error_message) for r in retrieve_or_error(rows, errors).collect()}
    assert got == {"a": ("5", "early"), "b": ("10", None), "c": (None, "at once"), "d": ("1", "alone")}


def test_lookup_broadcasts_what_is_small_and_joins_the_rest(spark):
    left = skewed(spark, 500)
    side = spark.createDataFrame([("s", "hot", "yes"), ("s", "none", "no")], "stream string, shard_id string, tag string")
    assert "Broadcast" in plan_of(lookup(left, side, SHARD_KEYS))
    for how in ("inner", "left", "left_semi", "left_anti"):
        same(lookup(left, side, SHARD_KEYS, how), left.join(side, SHARD_KEYS, how))
