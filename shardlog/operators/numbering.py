"""Exact row numbers per group that do not need a whole group in one task."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardlog.workdir import materialised

POSITION_BITS = 33  # of monotonically_increasing_id, below the partition's number


def same(left: str, right: str, columns: list[str]) -> Column:
    """Equality of columns of two aliased tables, null equal to null."""
    pairs = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(Column.__and__, pairs)


class Numbering:
    """The rows of a table in order, and where each group lies among the tasks that sorted it.

    Spark range-partitions by group, order and input position, so equal rows are
    split like any others, and a group that holds a third of the table is sorted
    by many tasks.  The sorted rows are written once; their running ids and the
    counts per group and partition give every row its number.
    """

    def __init__(self, df: DataFrame, keys: list[str], order_by: list[str]):
        self.columns, self.keys = df.columns, keys
        order = [*keys, *order_by, "_tie"]
        placed = (
            df.withColumn("_tie", F.monotonically_increasing_id())
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .drop("_tie")
            .withColumn("_id", F.monotonically_increasing_id())
        )
        self._rows = materialised(placed, "sorted").withColumn("_part", F.shiftright("_id", POSITION_BITS))
        # looked up in the ids of the sorted rows only, so asking for it twice costs little
        self._counts = self._rows.groupBy(*keys, "_part").agg(
            F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_least")
        )

    def sizes(self) -> DataFrame:
        """``_rows``, the number of rows of each group."""
        return self._counts.groupBy(*self.keys).agg(F.sum("_rows").alias("_rows"))

    def placed(self) -> DataFrame:
        """All rows with ``_id``, ascending in the order of the table, and ``_part``, the partition each lies in."""
        return self._rows

    def rows(self, name: str, per_group: DataFrame | None = None, placed: bool = False) -> DataFrame:
        """All rows with their number, and with the columns that ``per_group`` has for each group.

        With ``placed`` they keep ``_id`` and ``_part``.
        """
        earlier = (
            Window.partitionBy(*self.keys)
            .orderBy("_part")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
        places = self._counts.select(*self.keys, "_part", (before - F.col("_least")).alias("_offset"))
        more = []
        if per_group is not None:
            more = [c for c in per_group.columns if c not in self.keys]
            places = places.alias("p").join(per_group.alias("g"), same("p", "g", self.keys)).select("p.*", *more)
        where = same("r", "p", [*self.keys, "_part"])
        number = (F.col("r._id") + F.col("p._offset")).alias(name)
        joined = self._rows.alias("r").join(materialised(places, "places").alias("p"), where)
        kept = [*self.columns, *(["_id", "_part"] if placed else [])]
        return joined.select(*[f"r.{c}" for c in kept], number, *[f"p.{c}" for c in more])


def number_rows(
    df: DataFrame, keys: list[str], order_by: list[str], name: str = "row_no"
) -> DataFrame:
    """Number the rows of each group from 0, ascending by ``order_by``.

    Group keys may be null; rows equal in ``order_by`` are numbered in some order.
    """
    return Numbering(df, keys, order_by).rows(name)
