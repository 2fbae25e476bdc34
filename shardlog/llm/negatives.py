"""Hard negatives: rows of another label that score nearly as high as an anchor's positives.

Every vector is turned by a fixed rotation and coded by its signs: a code, and how far along
the code the vector lies (their alignment). What the code leaves over is turned again and
coded in the same way, ``LEVELS`` times; the length of what each level leaves is stored. An anchor's inner product with a code is a few counts of common bits, of the code
and of the bits of the anchor's rotated components. By Cauchy and Schwarz the product with
what is left over lies between two bounds, which holds for every vector, not for most. Level
by level, pairs whose interval shows that they cannot be among the results go; the others
are scored by their integers.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardlog.llm.vectors import integers, joined, matrix
from shardlog.workdir import materialised

FACTOR = 256
POSITIVES = 5
NEGATIVES = 5
LEVELS = 6  # codes of a vector; each leaves about 0.6 of its length over
BITS = 8  # of an anchor's components
ROWS_AT_ONCE = 1 << 17  # rows that one task holds
ANCHORS_AT_ONCE = 1 << 14  # anchors that meet them there
PAIRS_AT_ONCE = 1 << 20  # pairs looked at together
ROUNDING = 1e-6  # of the product of two lengths, added to intervals for the rounding of doubles


def rotations(d: int) -> list[np.ndarray]:
    """The rotation of each level, the same in every task."""
    random = np.random.default_rng(d)
    return [np.linalg.qr(random.normal(size=(d, d)))[0] for _ in range(LEVELS)]


class Codes:
    """Codes of vectors in the rows of ``q``: signs, alignment with them and what each level leaves over."""

    def __init__(self, q: np.ndarray, turns: list[np.ndarray]):
        (n, d), levels = q.shape, len(turns)
        words, rest = -(-d // 64), q
        self.signs = np.zeros((n, levels, words), "<u8")
        self.along, self.left = np.zeros((n, levels)), np.zeros((n, levels))
        for level, turn in enumerate(turns):
            rest = rest @ turn
            up = rest > 0
            bits = np.zeros((n, words * 64), bool)
            bits[:, :d] = up
            self.signs[:, level] = np.packbits(bits, axis=1, bitorder="little").view("<u8")
            side = np.where(up, 1.0, -1.0) / np.sqrt(d)
            self.along[:, level] = (rest * side).sum(axis=1)
            rest = rest - self.along[:, level, None] * side
            self.left[:, level] = np.sqrt((rest * rest).sum(axis=1))


class Asked:
    """Rotated anchors ``x`` as bits: component = low + step * number, but for a small known error."""

    def __init__(self, x: np.ndarray, bits: int = BITS):
        n, d = x.shape
        words = -(-d // 64)
        self.length = np.sqrt((x * x).sum(axis=1))
        self.low = x.min(axis=1) if d else np.zeros(n)
        self.step = np.maximum((x.max(axis=1) - self.low) / ((1 << bits) - 1), 1e-12) if d else np.ones(n)
        number = np.round((x - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        self.total = number.sum(axis=1)
        self.error = np.abs(x - self.low[:, None] - self.step[:, None] * number).sum(axis=1) / np.sqrt(max(d, 1))
        planes = np.zeros((n, bits, words * 64), bool)
        planes[:, :, :d] = (number[:, None, :] >> np.arange(bits)[:, None]) & 1
        self.planes = np.packbits(planes, axis=2, bitorder="little").view("<u8")
        self.d = d

    def product(self, i: np.ndarray, signs: np.ndarray) -> np.ndarray:
        """Of the anchors ``i`` with the codes ``signs``, by counting common bits."""
        ones = np.bitwise_count(signs).sum(axis=1, dtype=np.int64)
        common = np.zeros(len(i), np.int64)
        for bit in range(self.planes.shape[1]):
            common += np.bitwise_count(self.planes[i, bit] & signs).sum(axis=1, dtype=np.int64) << bit
        whole = self.low[i] * (2 * ones - self.d) + self.step[i] * (2 * common - self.total[i])
        return whole / np.sqrt(max(self.d, 1))


def _best(i: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Where each ``i`` has its ``k`` highest scores, of equal ones those with the smallest ids."""
    order = np.lexsort((ids, -score, i))
    group = i[order]
    first = np.append(0, np.flatnonzero(group[1:] != group[:-1]) + 1) if len(group) else np.zeros(0, int)
    place = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
    return order[place < k]


class Block:
    """Some anchors and some rows, all in one task."""

    def __init__(self, rows: pa.Table, anchors: pa.Table, d: int):
        levels, words = LEVELS, -(-d // 64)
        self.row, self.ids, self.label = (np.asarray(rows.column(c)) for c in ("row", "vec_id", "label"))
        self.q = matrix(rows.column("q"), d)
        self.signs = joined(rows.column("signs"), "<u8").reshape(len(self.row), levels, words)
        stored = joined(rows.column("lengths"), "<f8").reshape(len(self.row), 2, levels)
        self.along, self.left = stored[:, 0], stored[:, 1]
        self.size = np.sqrt((self.along**2).sum(axis=1) + self.left[:, -1] ** 2)
        self.a_row, self.a_label = np.asarray(anchors.column("row")), np.asarray(anchors.column("label"))
        self.a_q = matrix(anchors.column("q"), d)
        turned, self.asked = self.a_q.astype(float), []
        for turn in rotations(d):
            turned = turned @ turn
            self.asked.append(Asked(turned))
        self.looked_at = self.scored = 0

    def pairs(self, alike: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Anchors and rows of the same label, or of another one, some at a time; all rows of an anchor together."""
        at_once = max(1, PAIRS_AT_ONCE // max(1, len(self.row)))
        for start in range(0, len(self.a_row), at_once):
            some = slice(start, start + at_once)
            same = self.a_label[some, None] == self.label
            chosen = same & (self.a_row[some, None] != self.row) if alike else ~same
            i, j = np.nonzero(chosen)
            yield i + start, j

    def narrowed(self, i: np.ndarray, j: np.ndarray, useful) -> tuple[np.ndarray, np.ndarray]:
        """The pairs left by ``useful(i, low, high)``, which is asked at each level."""
        self.looked_at += len(i)
        so_far, slack = np.zeros(len(i)), ROUNDING * self.asked[0].length[i] * self.size[j]
        for level, asked in enumerate(self.asked):
            along = self.along[j, level]
            product = asked.product(i, self.signs[j, level])
            so_far = so_far + along * product
            slack = slack + np.abs(along) * asked.error[i]
            # what is left over is at right angles to the level's own code, so only the anchor's part beside that counts
            beside = np.maximum(asked.length[i] ** 2 - np.maximum(np.abs(product) - asked.error[i], 0) ** 2, 0)
            off = self.left[j, level] * np.sqrt(beside) + slack
            kept = useful(i, so_far - off, so_far + off)
            i, j, so_far, slack = i[kept], j[kept], so_far[kept], slack[kept]
        return i, j

    def score(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        self.scored += len(i)
        out, at_once = np.zeros(len(i), np.int64), max(1, (PAIRS_AT_ONCE * 8) // max(1, self.q.shape[1]))
        for start in range(0, len(i), at_once):
            some = slice(start, start + at_once)
            out[some] = np.einsum("ij,ij->i", self.a_q[i[some]].astype(np.int64), self.q[j[some]].astype(np.int64))
        return out

    def positives(self, k: int) -> pa.Table:
        """Each anchor's ``k`` best rows of its label in this block."""
        found = []
        for i, j in self.pairs(alike=True):

            def useful(i, low, high):
                lowest = np.full(len(self.a_row), -np.inf)
                kth = _best(i, low, np.zeros(len(i), int), k)
                which, counts = np.unique(i[kth], return_counts=True)
                full = which[counts == k]
                least = np.full(len(self.a_row), np.inf)
                np.minimum.at(least, i[kth], low[kth])
                lowest[full] = least[full]
                return high >= lowest[i]

            i, j = self.narrowed(i, j, useful)
            score = self.score(i, j)
            best = _best(i, score, self.ids[j], k)
            found.append((i[best], j[best], score[best]))
        i, j, score = (np.concatenate(x) if x else np.zeros(0, int) for x in (zip(*found, strict=True) if found else ((), (), ())))
        return pa.table({"anchor": self.a_row[i], "vec_id": self.ids[j], "score": score.astype(np.int64)})

    def negatives(self, windows: list[np.ndarray], k: int, share: int) -> pa.Table:
        """For each anchor and each of its positive scores, the ``k`` best rows of other labels within the score's window."""
        width = max([1, *map(len, windows)])
        tops = np.full((len(windows), width), np.iinfo(np.int64).min)  # none
        for a, of in enumerate(windows):
            tops[a, : len(of)] = of
        there = tops > np.iinfo(np.int64).min
        most = np.where(there, tops, -np.inf).max(axis=1, initial=-np.inf)
        least = np.where(there, share * (tops / 100), np.inf).min(axis=1, initial=np.inf)
        found = []
        for i, j in self.pairs(alike=False):
            i, j = self.narrowed(i, j, lambda i, low, high: (high >= least[i]) & (low <= most[i]))
            score = self.score(i, j)
            for w in range(width):
                top = tops[i, w]
                fits = np.flatnonzero(there[i, w] & (share * np.where(there[i, w], top, 0) <= 100 * score) & (score <= top))
                best = fits[_best(i[fits], score[fits], self.ids[j[fits]], k)]
                found.append((i[best], top[best], j[best], score[best]))
        i, top, j, score = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, int)] * 4
        return pa.table({"anchor": self.a_row[i], "top": top.astype(np.int64), "vec_id": self.ids[j], "score": score.astype(np.int64)})


def coded(rows: DataFrame, vector: str, factor: int) -> tuple[DataFrame, int]:
    """``(row, vec_id, label, q, signs, lengths)``, written once, and the most components that a vector has."""
    plain = materialised(integers(rows, vector, factor).withColumn("row", F.monotonically_increasing_id()), "integers")
    d = (plain.agg(F.max(F.octet_length("q"))).first()[0] or 0) // 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = rotations(d)
        for batch in batches:
            codes = Codes(matrix(batch.column("q"), d).astype(float), turns)
            lengths = np.stack([codes.along, codes.left], axis=1).astype("<f8")
            more = [pa.array([x.tobytes() for x in part], pa.binary()) for part in (codes.signs, lengths)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "signs", "lengths"])

    schema = plain.select("*", F.lit(b"").alias("signs"), F.lit(b"").alias("lengths")).schema
    return materialised(plain.mapInArrow(run, schema), "codes"), d


def _dealt(rows: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both in groups ``(g, s)`` of bounded size, so that every row meets every anchor in one of them."""
    spark = rows.sparkSession
    groups = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_AT_ONCE))
    slices = max(1, -(-anchors.count() // ANCHORS_AT_ONCE))

    def one_of(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    return (
        rows.select("*", one_of(groups).alias("g"), all_of(slices).alias("s")),
        anchors.select("*", one_of(slices).alias("s"), all_of(groups).alias("g")),
    )


def _first(df: DataFrame, keys: list[str], k: int, name: str = "rank") -> DataFrame:
    """The ``k`` highest scores of each group; Spark keeps ``k`` of each task's before it shuffles them."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return df.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def hard_negatives(
    rows: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label",
    is_anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, share: int = 80, factor: int = FACTOR,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    A score is the inner product of the integers floor(factor * x). An anchor's positives
    are the ``positives`` best other rows of its label. For each of them come the
    ``negatives`` best rows of other labels whose score is at most the positive's and at
    least ``share`` hundredths of it; of equal scores the smaller id comes first. Anchors
    are the rows that ``is_anchor`` marks, a column over ``key`` and ``label`` (default: ids
    that 100 divides).

    Rows with a null id, label, vector or component, or a component that is not finite (or
    in the thousands, see ``vectors.integers``), take no part. Shorter vectors count as
    filled up with zeros. Of rows with the same id each is a row of its own: it may be the
    other's positive, and if it is an anchor, the results come once for each. An empty table
    gives no rows.
    """
    chosen = rows.select(rows[key].alias("vec_id"), rows[label].cast("long").alias("label"), rows[vector].alias("_v"))
    is_anchor = F.col("vec_id") % 100 == 0 if is_anchor is None else is_anchor
    all_, d = coded(chosen.where("vec_id is not null and label is not null"), "_v", factor)
    anchors = all_.where(is_anchor).select("row", "vec_id", "label", "q")
    rows_dealt, anchors_dealt = _dealt(all_, anchors)
    by = rows_dealt.groupBy("g", "s")

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        return Block(left, right, d).positives(positives)

    kind = all_.schema["vec_id"].dataType.simpleString()
    partial = by.cogroup(anchors_dealt.groupBy("g", "s")).applyInArrow(near, f"anchor long, vec_id {kind}, score long")
    liked = materialised(_first(partial, ["anchor"], positives), "positives")

    tops = liked.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("score").alias("tops"))  # a few an anchor
    asking = anchors.join(tops, "row")

    def hard(left: pa.Table, right: pa.Table) -> pa.Table:
        windows = [np.array(t, np.int64) for t in right.column("tops").to_pylist()]
        return Block(left, right, d).negatives(windows, negatives, share)

    _, asking_dealt = _dealt(all_, materialised(asking, "asking"))
    partial = by.cogroup(asking_dealt.groupBy("g", "s")).applyInArrow(hard, f"anchor long, top long, vec_id {kind}, score long")
    found = _first(partial, ["anchor", "top"], negatives)
    answers = liked.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("top")).join(found, ["anchor", "top"])
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return answers.join(named, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("top").alias("positive_score"), F.col("score").alias("negative_score"),
    )
