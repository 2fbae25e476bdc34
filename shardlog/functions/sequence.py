"""Ordering of sequence numbers.

A sequence number is a decimal string of any length without leading zeros, so
neither string order nor a fixed-width decimal orders it.  The stored pair
(sequence_len, sequence_number) does, and comparisons on stored columns are
pushed into the Parquet scan.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def sequence_key() -> Column:
    return F.struct("sequence_len", "sequence_number")


def is_numbered() -> Column:
    """Whether a record has a sequence number; null and empty are none."""
    return F.coalesce(F.col("sequence_number") != "", F.lit(False))


def number_key() -> Column:
    """``sequence_key`` from the number alone, for rows whose length is missing."""
    number = F.col("sequence_number")
    return F.struct(F.length(number).alias("len"), number.alias("number"))


def after(length: Column | int, number: Column | str) -> Column:
    return (F.col("sequence_len") > length) | (
        (F.col("sequence_len") == length) & (F.col("sequence_number") > number)
    )


def at_or_after(length: Column | int, number: Column | str) -> Column:
    return (F.col("sequence_len") > length) | (
        (F.col("sequence_len") == length) & (F.col("sequence_number") >= number)
    )
