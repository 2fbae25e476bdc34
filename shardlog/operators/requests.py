"""Put requests within two limits at once: so many records and so many bytes.

A request takes records until the next one would exceed a limit, so where a request ends
depends on where it began, back to the first record of the shard.  That chain is broken
up: for a block of consecutive records it is worked out where each possible first request
(one of the first ``per_request`` records) leads in the block behind it.  Such tables are
put one behind the other, in a tree over the blocks, and give each block the place where
its first request really begins.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlog.operators.numbering import Numbering, same
from shardlog.operators.quota import put_bytes
from shardlog.schema import MAX_REQUEST_BYTES, MAX_REQUEST_RECORDS, SEQUENCE_ORDER, SHARD_KEYS
from shardlog.workdir import materialised

BLOCK = 1 << 16  # records of a shard that one task looks at together, at least ``per_request``
FANOUT = 256  # blocks put together by one task


class Limits(NamedTuple):
    """Of a request, and of the records of a shard that one task looks at together."""

    per_request: int
    max_bytes: int
    block: int

    def ends(self, sizes: np.ndarray) -> np.ndarray:
        """For each record the place behind a request that begins with it; a record too large goes alone."""
        n = len(sizes)
        before = np.append(0, np.cumsum(sizes))
        by_bytes = np.searchsorted(before, before[:-1] + self.max_bytes, side="right") - 1
        return np.minimum(np.maximum(np.minimum(np.arange(n) + self.per_request, by_bytes), np.arange(n) + 1), n)

    def leads(self, sizes: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """For each of the first ``per_request`` places: where the first request behind the block begins, and how many begin before.

        Pointers are doubled: in a few rounds each points behind the block's ``own`` records.
        """
        places = np.arange(len(sizes) + 1)
        to = np.append(self.ends(sizes), len(sizes))
        to = np.where(places < own, to, places)
        made = (places < own).astype(np.int64)
        while (to[: min(self.per_request, own)] < own).any():
            made, to = made + made[to], to[to]
        entries = np.arange(self.per_request)
        at = np.minimum(entries, len(sizes))
        return np.where(entries < own, to[at], entries) - own, np.where(entries < own, made[at], 0)

    def own(self, table: pa.Table) -> tuple[pa.Table, np.ndarray, int]:
        """The rows of a block and those behind it in order, their sizes, and how many are its own."""
        table = table.sort_by("_row")
        row, block = np.asarray(table.column("_row")), table.column("_block")[0].as_py()
        return table, np.asarray(table.column("_size")), int((row < (block + 1) * self.block).sum())


def _after(table: pa.Table, names: list[str], **columns) -> pa.Table:
    """The keys of a group and what was made for it."""
    rows = len(next(iter(columns.values())))
    keys = {name: pa.repeat(table.column(name)[0], rows) for name in names}
    return pa.table(keys | columns)


class Cuts:
    """Where requests begin, for rows numbered ``_row`` from 0 in each shard that have a ``_size``."""

    def __init__(self, rows: DataFrame, per_request: int, max_bytes: int, block: int, fanout: int):
        self.limits = Limits(per_request, max_bytes, max(block, per_request))
        self.fanout = max(2, fanout)
        keys = [rows.schema[k] for k in SHARD_KEYS]
        self.keys = T.StructType([T.StructField(k.name, k.dataType) for k in keys])
        block = self.limits.block
        mine = F.floor(F.col("_row") / block).cast("long")
        # the last request of a block may go on into the first records of the next one
        ahead = (F.col("_row") % block < per_request - 1) & (mine > 0)
        of = F.explode(F.when(ahead, F.array(mine, mine - 1)).otherwise(F.array(mine)))
        self.rows = rows.select(*SHARD_KEYS, "_row", "_size", of.alias("_block"))

    def _tables(self) -> DataFrame:
        limits = self.limits

        def leads(table: pa.Table) -> pa.Table:
            _, sizes, own = limits.own(table)
            to, made = limits.leads(sizes, own)
            return _after(table, [*SHARD_KEYS, "_block"], to=pa.array([to]), made=pa.array([made]))

        schema = T.StructType([*self.keys.fields, *self._lead_fields()])
        return materialised(self.rows.groupBy(*SHARD_KEYS, "_block").applyInArrow(leads, schema), "leads")

    @staticmethod
    def _lead_fields() -> list[T.StructField]:
        numbers = T.ArrayType(T.LongType())
        return [T.StructField("_block", T.LongType()), T.StructField("to", numbers), T.StructField("made", numbers)]

    def _together(self, level: DataFrame) -> DataFrame:
        """``FANOUT`` consecutive blocks as one."""

        entries = self.limits.per_request

        def together(table: pa.Table) -> pa.Table:
            table = table.sort_by("_block")
            at, made = np.arange(entries), np.zeros(entries, np.int64)
            for to, more in zip(table.column("to").to_pylist(), table.column("made").to_pylist(), strict=True):
                at, made = np.array(to)[at], made + np.array(more)[at]
            return _after(table, [*SHARD_KEYS, "_parent"], to=pa.array([at]), made=pa.array([made]))

        fields = self._lead_fields()
        schema = T.StructType([*self.keys.fields, T.StructField("_parent", T.LongType()), *fields[1:]])
        grouped = level.withColumn("_parent", F.floor(F.col("_block") / self.fanout).cast("long")).groupBy(*SHARD_KEYS, "_parent")
        return materialised(grouped.applyInArrow(together, schema).withColumnRenamed("_parent", "_block"), "leads")

    def _entered(self, level: DataFrame, above: DataFrame) -> DataFrame:
        """Where the first request of each block begins, and its number, from the same of the blocks above."""

        def walk(table: pa.Table) -> pa.Table:
            table = table.sort_by("_block")
            at, made, entries, firsts = table.column("_entry")[0].as_py(), table.column("_first")[0].as_py(), [], []
            for to, more in zip(table.column("to").to_pylist(), table.column("made").to_pylist(), strict=True):
                entries.append(at)
                firsts.append(made)
                at, made = to[at], made + more[at]
            return _after(table, SHARD_KEYS, _block=table.column("_block"), _entry=pa.array(entries, pa.int64()), _first=pa.array(firsts, pa.int64()))

        schema = T.StructType([*self.keys.fields, *(T.StructField(n, T.LongType()) for n in ("_block", "_entry", "_first"))])
        level = level.withColumn("_parent", F.floor(F.col("_block") / self.fanout).cast("long"))
        above = above.withColumnRenamed("_block", "_parent")
        joined = level.alias("l").join(above.alias("a"), same("l", "a", [*SHARD_KEYS, "_parent"])).select("l.*", "a._entry", "a._first")
        return materialised(joined.groupBy(*SHARD_KEYS, "_parent").applyInArrow(walk, schema), "entries")

    def assigned(self) -> DataFrame:
        """``(stream, shard_id, _row, _no, idx)``: the number of each row's request in its shard, and its place there."""
        levels = [self._tables()]
        most = levels[0].agg(F.max("_block")).first()[0] or 0
        while most > 0:
            levels.append(self._together(levels[-1]))
            most //= self.fanout
        zero = F.lit(0).cast("long")
        entered = levels[-1].select(*SHARD_KEYS, "_block", zero.alias("_entry"), zero.alias("_first"))
        for level in reversed(levels[:-1]):
            entered = self._entered(level, entered)

        limits = self.limits

        def assign(table: pa.Table) -> pa.Table:
            table, sizes, own = limits.own(table)
            ends, at, no = limits.ends(sizes), table.column("_entry")[0].as_py(), table.column("_first")[0].as_py()
            first, numbers, places = at, [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            while at < own:
                numbers.append(np.full(ends[at] - at, no, np.int64))
                places.append(np.arange(ends[at] - at, dtype=np.int32))
                at, no = int(ends[at]), no + 1
            rows = table.column("_row").slice(min(first, len(table)), max(0, at - first))
            return _after(table, SHARD_KEYS, _row=rows, _no=pa.array(np.concatenate(numbers)), idx=pa.array(np.concatenate(places)))

        schema = T.StructType([*self.keys.fields, T.StructField("_row", T.LongType()), T.StructField("_no", T.LongType()), T.StructField("idx", T.IntegerType())])
        where = same("r", "e", [*SHARD_KEYS, "_block"])
        rows = self.rows.alias("r").join(entered.alias("e"), where).select("r.*", "e._entry", "e._first")
        return rows.groupBy(*SHARD_KEYS, "_block").applyInArrow(assign, schema)


def put_shape_bytes(
    records: DataFrame, per_request: int = MAX_REQUEST_RECORDS, max_bytes: int = MAX_REQUEST_BYTES,
    order_by: list[str] | None = None, block: int = BLOCK, fanout: int = FANOUT,
) -> DataFrame:
    """``put_shape`` with requests of at most ``per_request`` entries and ``max_bytes`` bytes, keys included.

    In the order of a shard each request takes as much as fits; a record that is larger
    than ``max_bytes`` is a request of its own.  Only numbers and sizes are shuffled to find
    the cuts, ``block`` rows a task, however many of them belong to one shard; the payload
    then meets them by shard and number.
    """
    numbering = Numbering(records.withColumn("_size", put_bytes()), SHARD_KEYS, order_by or SEQUENCE_ORDER)
    rows = numbering.rows("_row")
    found = materialised(Cuts(rows, per_request, max_bytes, block, fanout).assigned(), "cuts")
    before = Window.orderBy(*SHARD_KEYS).rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard, so the ordered running sum is over a small table.
    counts = found.groupBy(*SHARD_KEYS).agg((F.max("_no") + 1).alias("_n"))
    firsts = counts.select(*SHARD_KEYS, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    numbered = found.alias("f").join(materialised(firsts, "firsts").alias("b"), same("f", "b", SHARD_KEYS))
    numbered = numbered.select("f.*", (F.col("b._base") + F.col("f._no")).alias("request_id"))
    joined = rows.alias("r").join(numbered.alias("n"), same("r", "n", [*SHARD_KEYS, "_row"]))
    key = F.coalesce("r.partition_key", F.lit("")).alias("partition_key")
    return joined.select("r.stream", "n.request_id", "n.idx", key, "r.data")
