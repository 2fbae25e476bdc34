"""Attach one-row-per-key tables (positions, marks, statuses) to records."""

from pyspark.sql import DataFrame

from shardlog.workdir import materialised


def lookup(records: DataFrame, side: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join records with a table that has at most one row per key.

    The table is stored first, so it is computed once and Spark knows its size: a
    small one is broadcast and records stay where they are.  Otherwise both sides
    are shuffled, and adaptive execution splits a key that holds a large share.
    """
    return records.join(materialised(side, "side"), keys, how)
