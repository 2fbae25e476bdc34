"""Vectors of floats as vectors of integers, which compare and add exactly."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def largest(d: int | np.ndarray) -> int | np.ndarray:
    """Up to here components give 64-bit inner products, distances and sums, in ``d`` dimensions."""
    return (1 << 30) // np.maximum(d, 8)


def integers(rows: DataFrame, vector: str, factor: int) -> DataFrame:
    """``rows`` with ``q`` in place of the vector: floor(factor * x) of each component x as a double.

    ``q`` holds little-endian signed 32-bit numbers. Rows are left out whose vector is null,
    holds a null or non-finite component, or one that ``largest`` forbids (beyond some
    thousands, where a vector has fewer than a thousand dimensions). An empty vector stays.
    """
    keys = [c for c in rows.columns if c != vector]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(vector)
            size = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
            ends = np.cumsum(size)
            parts = pc.list_flatten(column).cast(pa.float64())
            q = np.floor(factor * np.asarray(pc.fill_null(parts, float("nan"))))
            odd = np.append(0, np.cumsum(~(np.abs(q) <= np.repeat(largest(size), size))))
            good = np.asarray(pc.is_valid(column)) & (odd[ends] == odd[ends - size])
            numbers = np.where(np.isfinite(q), np.clip(q, -(1 << 31), (1 << 31) - 1), 0).astype("<i4")
            offsets = np.append(0, 4 * ends).astype("<i4")
            values = pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(offsets), pa.py_buffer(numbers)])
            kept = pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), values], names=[*keys, "q"])
            yield kept.filter(pa.array(good))

    return rows.select(*keys, vector).mapInArrow(run, rows.select(*keys).schema.add("q", "binary"))


def joined(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """The binary values of a column, one behind the other, as numbers of one kind."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def matrix(column: pa.Array | pa.ChunkedArray, d: int, kind: str = "<i4") -> np.ndarray:
    """Binary vectors of at most ``d`` numbers as the rows of a matrix, filled up with zeros."""
    size = np.asarray(pc.binary_length(column), np.int64) // np.dtype(kind).itemsize
    out = np.zeros((len(column), d), kind)
    out[np.arange(d) < size[:, None]] = joined(column, kind)
    return out
