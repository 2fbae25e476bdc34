"""Running sums, maxima and last values per group, without a whole group in one task.

The rows of ``Numbering`` are sorted over range partitions.  Each partition gives one
total a group; what the partitions before it add up to is carried into it, and the rest
is a window over the partition's own rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardlog.operators.numbering import Numbering, same
from shardlog.workdir import materialised

SUM, MAX, LAST = "sum", "max", "last"


def _over_rows(kind: str, value: str) -> Column:
    if kind == LAST:
        return F.last(value, ignorenulls=True)
    return F.sum(value) if kind == SUM else F.max(value)


def _total(kind: str, value: str) -> Column:
    if kind == LAST:
        return F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_id")))
    return F.sum(value) if kind == SUM else F.max(value)


def _both(kind: str, carried: Column, own: Column) -> Column:
    if kind == LAST:
        return F.coalesce(own, carried)
    if kind == MAX:
        return F.greatest(carried, own)  # the other one where one is null
    return F.coalesce(carried, F.lit(0)) + F.coalesce(own, F.lit(0))


def running(rows: DataFrame, group: list[str], wanted: dict[str, tuple[str, Column]]) -> DataFrame:
    """``rows`` with a column for each of ``wanted``: its kind over the group's rows so far, itself included.

    ``rows`` come from ``Numbering.placed`` and carry ``_id`` and ``_part``.  A group is part
    of a group of that numbering or finer, and may hold any share of the rows: a task holds
    the part of it that lies in one range partition.  Nulls do not count.
    """
    values = {f"_v_{name}": value for name, (_, value) in wanted.items()}
    rows = rows.withColumns(values)
    totals = rows.groupBy(*group, "_part").agg(*(_total(kind, f"_v_{n}").alias(f"_t_{n}") for n, (kind, _) in wanted.items()))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*group, "_part", *(_over_rows(kind, f"_t_{n}").over(earlier).alias(f"_c_{n}") for n, (kind, _) in wanted.items()))
    where = same("r", "c", [*group, "_part"])
    joined = rows.alias("r").join(materialised(carried, "carried").alias("c"), where).select("r.*", *(f"c._c_{n}" for n in wanted))
    own = Window.partitionBy(*group, "_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    made = {n: _both(kind, F.col(f"_c_{n}"), _over_rows(kind, f"_v_{n}").over(own)) for n, (kind, _) in wanted.items()}
    return joined.withColumns(made).drop(*values, *(f"_c_{n}" for n in wanted))


def running_over(df: DataFrame, keys: list[str], order_by: list[str], wanted: dict[str, tuple[str, Column]]) -> DataFrame:
    """``running`` over each group of ``keys`` in the order of ``order_by``."""
    return running(Numbering(df, keys, order_by).placed(), keys, wanted).drop("_id", "_part")
