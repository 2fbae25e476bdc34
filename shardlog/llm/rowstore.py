"""Rows written once in numbered chunks, so that decisions travel instead of texts.

A chunk is what one task wrote; a row is known by its chunk and its position there. The
table is bucketed by chunk, so a later decision for every row of a chunk comes back as one
small row (a number for each position) and meets the texts without shuffling them.
"""

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlog.workdir import named_table, work_dir

POSITION_BITS = 33  # of monotonically_increasing_id


def stored(df: DataFrame, name: str, **derived: Column) -> DataFrame:
    """``df`` written as ``(chunk, pos, row, *derived)``; ``row`` holds all its columns.

    Because the columns stand inside ``row``, none of them can clash with the others.
    """
    spark = df.sparkSession
    rows = df.select(
        F.monotonically_increasing_id().alias("id"), F.struct(*df.columns).alias("row"), *(c.alias(n) for n, c in derived.items())
    ).select(
        F.shiftright("id", POSITION_BITS).alias("chunk"),
        F.col("id").bitwiseAND((1 << POSITION_BITS) - 1).cast("int").alias("pos"),
        "row",
        *derived,
    )
    called = named_table(f"rows_{uuid.uuid4().hex}")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.write.format("parquet").option("compression", "zstd").option("path", work_dir(spark, name))
    writer.bucketBy(buckets, "chunk").saveAsTable(called)
    return spark.table(called)


def by_chunk(decisions: DataFrame) -> DataFrame:
    """``(chunk, pos, value)`` as one row a chunk: ``values``, a number by position.

    Positions that are not named have 0. A chunk is bounded by what one task reads.
    """

    def dense(rows: pd.DataFrame) -> pd.DataFrame:
        pos = rows["pos"].to_numpy()
        values = np.zeros(pos.max() + 1, np.int32)
        values[pos] = rows["value"]
        return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "values": [values]})

    return (
        decisions.select("chunk", "pos", F.col("value").cast("int").alias("value"))
        .groupBy("chunk")
        .applyInPandas(dense, "chunk long, values array<int>")
    )


def with_value(store: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """The stored rows, each with the value that its chunk has for it (0 without one)."""
    own = values.select("chunk", F.col("values").alias("_values")).hint("shuffle_hash")
    value = F.coalesce(F.get("_values", F.col("pos")), F.lit(0)).alias(name)
    return store.join(own, "chunk", "left").select(*store.columns, value)


def rows_of(marked: DataFrame) -> DataFrame:
    """The columns that the table had before it was stored."""
    return marked.select("row.*")
