"""Small hand-made tables."""

import datetime as dt

from shardlog.schema import CHECKPOINT, POSITION, RECORD, REQUEST, RESPONSE_ENTRY, RESPONSE_HEAD

BIG = "49590338271490256608559692538361571095921575989136588898"  # 56 digits
T0 = dt.datetime(2024, 1, 1)


def record(shard, number, key="k", data=b"x", at=0, stream="s"):
    length = None if number is None else len(number)
    return (stream, shard, number, length, key, data, T0 + dt.timedelta(seconds=at))


def records(spark, rows):
    return spark.createDataFrame(rows, RECORD)


def position(shard, name, number=None, at=None, stream="s"):
    return (stream, shard, name, number, None if at is None else T0 + dt.timedelta(seconds=at))


def positions(spark, rows):
    return spark.createDataFrame(rows, POSITION)


def checkpoints(spark, rows):
    return spark.createDataFrame([("s", s, n, len(n)) for s, n in rows], CHECKPOINT)


def numbers(df):
    return sorted((r.shard_id, r.sequence_number) for r in df.collect())


def requests(spark, rows):
    return spark.createDataFrame([("s", *row) for row in rows], REQUEST)


def heads(spark, rows):
    return spark.createDataFrame(rows, RESPONSE_HEAD)


def entries(spark, rows):
    return spark.createDataFrame(rows, RESPONSE_ENTRY)


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
