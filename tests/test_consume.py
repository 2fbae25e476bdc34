import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shardlog.functions.message import (
    append_terminator,
    key_bytes,
    message,
    position_name,
    set_value,
    status_name,
    value,
    value_text,
)
from shardlog.operators.consume import (
    error_counts,
    for_each_message,
    message_counts,
    observe_messages,
    retrieve_fn,
    split_errors,
)
from shardlog.operators.status import active_only, rejected, rejected_streams
from shardlog.schema import STREAM
from shardlog.sources.log import deliver_payload, write_payload
from tests.util import BIG, record, records

PAYLOADS = [b'{"foo":"bar"}', b'{"bar":"baz"}', b'{"baz":"qux"}']


def three(spark):
    return records(spark, [record("0", str(i), "test", p) for i, p in enumerate(PAYLOADS)])


def test_each_payload_is_handled_and_comes_back_equal(spark):
    done = for_each_message(three(spark), lambda payload: bytes(payload), "binary")
    assert {bytes(r.value) for r in done.collect()} == set(PAYLOADS)
    assert done.where("error_message is not null").isEmpty()


@pytest.mark.parametrize("concurrency", [None, 1, 5])
def test_an_error_is_kept_and_handling_goes_on(spark, concurrency):
    def first_key(payload):
        if payload == PAYLOADS[1]:
            raise RuntimeError("All your base are belong to us")
        return next(iter(json.loads(payload)))

    done = for_each_message(three(spark), first_key, "string", concurrency)
    good, errors = split_errors(done)
    assert {r.value for r in good.collect()} == {"foo", "baz"}
    row = errors.first()
    assert (row.shard_id, row.sequence_number) == ("0", "1")
    counted = error_counts(errors).first()
    assert (counted.error_message, counted.n_errors) == ("All your base are belong to us", 1)


def test_results_may_be_null_and_mixed_with_errors(spark):
    def parse(payload):
        if payload == b"none":
            return None
        return int(payload)

    rows = [record("0", str(i), data=d) for i, d in enumerate([b"1", b"none", b"x", b"4"])]
    got = for_each_message(records(spark, rows), parse, "bigint").orderBy("sequence_number").collect()
    assert [r.value for r in got] == [1, None, None, 4]
    assert [r.error_message is not None for r in got] == [False, False, True, False]


def test_concurrency_must_be_positive(spark):
    with pytest.raises(ValueError, match="Concurrency must be greater than zero"):
        for_each_message(three(spark), len, "int", 0)


def test_retrieve_fn_handles_one_message_per_shard(spark):
    rows = [record("a", "10", data=b"ten"), record("a", "9", data=b"nine"), record("b", BIG, data=b"b")]
    got = retrieve_fn(records(spark, rows), lambda p: p.decode(), "string").collect()
    assert {(r.shard_id, r.value) for r in got} == {("a", "nine"), ("b", "b")}


def test_counts_with_and_without_a_pass_of_their_own(spark):
    rows = records(spark, [record("a", "1"), record("a", "2"), record("b", "1")])
    assert {(r.shard_id, r.n_messages) for r in message_counts(rows).collect()} == {("a", 2), ("b", 1)}
    seen = Observation("seen")
    observe_messages(rows, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n_messages": 3}


def test_message_functions(spark):
    rows = records(spark, [record("0", "1", None, b"a"), record("0", "2", "", b""), record("0", "3", "é", b"c")])
    got = rows.orderBy("sequence_number").select(
        key_bytes().alias("key"),
        value().alias("v"),
        value_text().alias("t"),
        append_terminator(F.col("data"), b"\n").alias("ended"),
        append_terminator(F.col("data")).alias("same"),
        message(F.col("data"), F.col("partition_key")).alias("m"),
    ).collect()
    assert [None if r.key is None else bytes(r.key) for r in got] == [None, b"", "é".encode()]
    assert [bytes(r.ended) for r in got] == [b"a\n", b"\n", b"c\n"]
    empty = records(spark, [record("0", "1", data=None)])
    assert bytes(deliver_payload(empty, b";").first().data) == b";"
    assert [bytes(r.same) for r in got] == [bytes(r.v) for r in got] == [b"a", b"", b"c"]
    assert all(r.m.sequence_number is None for r in got)
    assert bytes(set_value(rows, F.lit(bytearray(b"new"))).first().data) == b"new"


def test_code_names(spark):
    got = spark.range(-1, 9).select(position_name(F.col("id")), status_name(F.col("id"))).collect()
    assert [r[0] for r in got] == [
        "",
        "AT_SEQUENCE_NUMBER",
        "AFTER_SEQUENCE_NUMBER",
        "TRIM_HORIZON",
        "LATEST",
        *[""] * 5,
    ]
    assert [r[1] for r in got] == [*[""] * 5, "CREATING", "DELETING", "ACTIVE", "UPDATING", ""]


def test_only_active_streams_are_used(spark):
    status = spark.createDataFrame([("on", "ACTIVE"), ("off", "CREATING"), ("odd", None)], STREAM)
    rows = records(spark, [record("0", "1", stream=s) for s in ("on", "off", "odd", "unknown")])
    assert [r.stream for r in active_only(rows, status).collect()] == ["on"]
    assert {(r.stream, r.reason) for r in rejected_streams(status).collect()} == {
        ("off", "The Stream is not yet active"),
        ("odd", "Nil stream status"),
    }
    refused = {r.stream: r.reason for r in rejected(rows, status).collect()}
    assert refused == {
        "off": "The Stream is not yet active",
        "odd": "Nil stream status",
        "unknown": "The Stream is not known",
    }
    nameless = records(spark, [record("0", "1")]).withColumn("stream", F.lit(None).cast("string"))
    assert active_only(nameless, status).count() + rejected(nameless, status).count() == 1


def test_payload_sinks(spark, tmp_path):
    rows = three(spark)
    assert deliver_payload(rows).columns == ["data"]
    write_payload(rows, str(tmp_path / "bytes"))
    stored = spark.read.parquet(str(tmp_path / "bytes"))
    assert {bytes(r.data) for r in stored.collect()} == set(PAYLOADS)
    write_payload(rows.coalesce(1), str(tmp_path / "text"), line_sep="\n")
    (part,) = (tmp_path / "text").glob("part-*")
    assert sorted(part.read_bytes().split(b"\n")) == sorted([b"", *PAYLOADS])


def test_bytes_that_are_no_text(spark, tmp_path):
    odd = [b"\xff\xfe\x80", b"fine", "é".encode()]
    rows = records(spark, [record("0", str(i), data=d) for i, d in enumerate(odd)])
    write_payload(rows, str(tmp_path / "bytes"), terminator=b"\n")
    stored = spark.read.parquet(str(tmp_path / "bytes"))
    assert {bytes(r.data) for r in stored.collect()} == {d + b"\n" for d in odd}
    write_payload(rows, str(tmp_path / "text"), line_sep="\n")
    assert {r.value for r in spark.read.text(str(tmp_path / "text")).collect()} == {"fine", "é"}
    left = spark.read.parquet(str(tmp_path / "text-undecodable"))
    assert [bytes(r.data) for r in left.collect()] == [odd[0]]


def test_a_result_of_another_type_is_an_error_row(spark):
    rows = records(spark, [record("0", "1", data=b"1"), record("0", "2", data=b"x")])
    got = for_each_message(rows, lambda p: int(p) if p == b"1" else p.decode(), "bigint").collect()
    assert {(r.sequence_number, r.value, r.error_message is None) for r in got} == {("1", 1, True), ("2", None, False)}
