"""Vector code compression: a small codebook for each part of a vector, searched by equal averages.

The entries of a codebook are sorted by the sum of their components. The search for the
entry nearest to a part starts where the part's own sum falls and moves outward. By the
inequality of means a squared distance is at least the squared gap of the sums over the
number of components, so a part is done when that strictly exceeds its best distance.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardlog.llm.vectors import integers, matrix
from shardlog.operators.numbering import same
from shardlog.workdir import materialised

FACTOR = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part the index of its nearest entry, the lower of equally near ones, and the squared distance."""
    n, d = parts.shape
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    ranked, sums = entries[order], sums[order]
    own = parts.sum(axis=1)
    found, best = np.full(n, len(entries)), np.full(n, np.iinfo(np.int64).max)
    up = np.searchsorted(sums, own)
    down = up - 1
    rows = np.arange(n) if d else np.zeros(0, int)  # those not done yet
    far = np.iinfo(np.int64).max
    while len(rows):
        lower, upper = down[rows], up[rows]
        below = np.where(lower >= 0, own[rows] - sums[lower], far)
        above = np.where(upper < len(sums), sums[np.minimum(upper, len(sums) - 1)] - own[rows], far)
        gap = np.minimum(below, above)
        open_ = gap < far
        # the gap is squared only where there is one; best is the largest number before the first distance
        open_[open_] = gap[open_] ** 2 <= np.where(best[rows[open_]] == far, far, best[rows[open_]] * d)
        rows, goes_down = rows[open_], (below <= above)[open_]
        at = np.where(goes_down, lower[open_], upper[open_])
        distance = ((parts[rows] - ranked[at]) ** 2).sum(axis=1)
        entry = order[at]
        better = (distance < best[rows]) | ((distance == best[rows]) & (entry < found[rows]))
        found[rows[better]], best[rows[better]] = entry[better], distance[better]
        down[rows] -= goes_down
        up[rows] += ~goes_down
    return found, best


class Codebooks:
    """One codebook for each part position of the vectors in ``vectors (vec_id, ..., q)``, all of one length.

    They start as the parts of the vectors with the smallest ids (of equal ids, the smaller
    vector), fewer if there are fewer rows, null ids last. A round assigns every part to its
    nearest entry and moves each entry to the floor of its parts' mean; entries without
    parts stay. Each task sends one sum for each component of the codebooks, whatever the
    number of its rows, and the driver holds the codebooks only.
    """

    def __init__(self, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
        if not 0 < entries <= 256:
            raise ValueError("a code has one byte for each part")
        self.parts = parts
        # order of binary values is not that of numbers, but one order all the same
        first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "q").select("q").limit(entries).collect()
        start = np.array([np.frombuffer(r.q, "<i4") for r in first], np.int64)
        self.size = start.shape[1] if len(start) else 0  # of the vectors
        self.books = start.reshape(len(start), parts, -1).transpose(1, 0, 2) if self.size else np.zeros((parts, 0, 0), np.int64)
        for _ in range(rounds if self.size else 0):
            self._move(vectors)

    def assigned(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (a column a part) and squared distances, for the vectors in the rows of ``q``."""
        split = q.astype(np.int64).reshape(len(q), self.parts, -1)
        found = [nearest(split[:, p], self.books[p]) for p in range(self.parts)]
        return np.stack([f for f, _ in found], axis=1), sum(b for _, b in found)

    def _move(self, vectors: DataFrame) -> None:
        parts, entries, d = self.books.shape

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((parts, entries, d + 1), np.int64)  # the last one counts
            for batch in batches:
                q = matrix(batch.column("q"), self.size)
                codes, _ = self.assigned(q)
                split = q.astype(np.int64).reshape(len(q), parts, d)
                for p in range(parts):
                    of = codes[:, p] == np.arange(entries)[:, None]
                    sums[p, :, :d] += of.astype(np.int64) @ split[:, p]
                    sums[p, :, d] += of.sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size)), pa.array(sums.ravel())], names=["place", "n"])

        sums = np.zeros(self.books.size + parts * entries, np.int64)
        for place, n in vectors.select("q").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n")).collect():
            sums[place] = n  # as many rows as the codebooks have numbers
        sums = sums.reshape(parts, entries, d + 1)
        count = sums[:, :, d:]
        self.books = np.where(count > 0, sums[:, :, :d] // np.maximum(count, 1), self.books)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def compressed(
    rows: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, factor: int = FACTOR,
) -> tuple[DataFrame, Codebooks]:
    """One row a vector: ``vec_id``, ``label``, ``code`` (binary, a byte a part), ``error``, ``label_error``; and the codebooks.

    Left out are rows whose vector is null, empty, holds a null or non-finite component (or
    one of many thousands, see ``vectors.integers``), or cannot be cut: vectors have the
    length of the one with the smallest id among those of lengths that ``parts`` divides.
    Repeated rows are coded each. Null ids and labels stay; null labels are one label. A
    table without vectors gives no rows.
    """
    found = integers(rows.select(rows[key].alias("vec_id"), rows[label].alias("label"), rows[vector].alias("_v")), "_v", factor)
    length = F.octet_length("q")
    found = materialised(found.where((length > 0) & (length % (4 * parts) == 0)), "vectors")
    first = found.orderBy(F.col("vec_id").asc_nulls_last(), "q").select(length.alias("n")).first()
    found = found.where(length == (first.n if first else 0))
    books = Codebooks(found, parts, entries, rounds)
    schema = found.drop("q").schema.add("code", "binary").add("error", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, error = books.assigned(matrix(batch.column("q"), books.size))
            code = pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), code, pa.array(error)], names=["vec_id", "label", "code", "error"]
            )

    coded = materialised(found.mapInArrow(run, schema), "codes")
    sums = materialised(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    joined = coded.alias("c").join(sums.alias("s"), same("c", "s", ["label"]))
    return joined.select("c.*", "s.label_error"), books
