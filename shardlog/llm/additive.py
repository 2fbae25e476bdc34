"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are cut into bins. Shallow trees, boosted one feature after another in
cycles, add up to one lookup table a feature; then to one for each of a few pairs of
features. A score is a sum of table entries.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlog.llm.common import lowest, text_of
from shardlog.llm.language import held_out
from shardlog.workdir import materialised

SAMPLE = 20_000  # labelled documents that the model is fitted on, at most
BINS = 32
PAIR_BINS = 8
PAIRS = 6
CYCLES = 150
RATE = 0.1
LEAST = 10  # rows in a leaf
ACCEPTED = 0.3  # score from which a document is predicted to be good
# fixed values
SYMBOLS = "#*$%&|<>"
NAMES = (
    "words", "word_length", "longest_word", "symbols", "bars", "capitals", "shouts", "digits", "stops", "others",
    "dup_lines", "repeats", "distinct_words", "commonest", "short_words", "lines", "marked_words", "end_of_line",
)


def features(text: str) -> list[float]:
    """The numbers in ``NAMES``, of a whole text. A text without words has zeros only."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    code = np.frombuffer(text.encode("utf-32-le"), "<u4")
    ascii_ = np.bincount(code[code < 128], minlength=128)
    lengths = np.fromiter(map(len, words), np.int64, n)
    chars = int(lengths.sum())
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    times = Counter(words)
    number = {w: i for i, w in enumerate(times)}
    which = np.fromiter(map(number.__getitem__, words), np.int64, n)
    repeated = 0
    if n >= 3:
        windows = (which[:-2] * len(number) + which[1:-1]) * len(number) + which[2:]
        _, back, often = np.unique(windows, return_inverse=True, return_counts=True)
        hit = np.flatnonzero(often[back] > 1)
        covered = np.zeros(n, bool)
        for i in range(3):
            covered[hit + i] = True
        repeated = int(covered.sum())
    symbols = int(sum(ascii_[ord(c)] for c in SYMBOLS))
    inner = sum(1 for w in times if not w[:-1].isalpha() and len(w) > 1)
    return [
        float(np.log1p(n)), chars / n, float(np.log1p(lengths.max())), symbols / chars, ascii_[124] / n, ascii_[65:91].sum() / chars,
        ascii_[33] / n, ascii_[48:58].sum() / chars, (ascii_[46] + ascii_[44]) / n, np.count_nonzero(code > 127) / chars,
        1 - len(set(lines)) / len(lines), repeated / n, len(times) / n, max(times.values()) / n,
        np.count_nonzero(lengths <= 3) / n, float(np.log1p(n / len(lines))), inner / len(times),
        sum(x.rstrip()[-1] in ".!?" for x in lines) / len(lines),
    ]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _split(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """The best gain of cutting a histogram in two, and the first bin on the right (0: none)."""
    left = [np.cumsum(x)[:-1] for x in (g, h, n)]
    right = [x.sum() - c for x, c in zip((g, h, n), left, strict=True)]
    fits = (left[2] >= LEAST) & (right[2] >= LEAST)
    if not fits.any():
        return 0.0, 0
    gain = left[0] ** 2 / (left[1] + 1) + right[0] ** 2 / (right[1] + 1) - g.sum() ** 2 / (h.sum() + 1)
    gain = np.where(fits, gain, -1.0)
    best = int(gain.argmax())
    return (float(gain[best]), best + 1) if gain[best] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """The leaf values of a shallow tree over one feature's bins, by bin."""
    _, cut = _split(g, h, n) if depth else (0.0, 0)
    if not cut:
        return np.full(len(g), g.sum() / (h.sum() + 1))
    return np.concatenate([_tree(g[:cut], h[:cut], n[:cut], depth - 1), _tree(g[cut:], h[cut:], n[cut:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree of one cut along one feature and one along the other on either side: its gain and leaf values."""
    best = (0.0, np.zeros_like(g))
    for turn in (False, True):
        a, b, c = (x.T if turn else x for x in (g, h, n))
        whole = a.sum() ** 2 / (b.sum() + 1)
        for cut in range(1, len(a)):
            value, gain = np.zeros_like(a), -whole
            for part in (slice(None, cut), slice(cut, None)):
                rows = [x[part].sum(axis=0) for x in (a, b, c)]
                leaves = _tree(*rows, depth=1)
                value[part] = leaves
                gain += float((2 * leaves * rows[0] - leaves**2 * (rows[1] + 1e-9)).sum())
            if gain > best[0] + 1e-9:
                best = (gain, value.T if turn else value)
    return best


def _cuts(values: np.ndarray) -> np.ndarray:
    """Where bins meet: at quantiles of the values and of the distinct values, so that rare ones have bins too."""
    if not len(values):
        return np.zeros(0)
    at = np.linspace(0, 1, BINS // 2 + 1)[1:-1]
    return np.unique(np.concatenate([np.quantile(values, at), np.quantile(np.unique(values), at)]))


class Additive:
    """The fitted tables. Without labels of both kinds, every score is the share of good ones, or one half."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        k = x.shape[1]
        self.cuts = [_cuts(x[:, j]) for j in range(k)]
        self.coarse = [c if len(c) < PAIR_BINS else c[np.linspace(0, len(c) - 1, PAIR_BINS + 1)[1:-1].round().astype(int)] for c in self.cuts]
        self.tables = np.zeros((k, BINS))
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables = np.zeros((0, PAIR_BINS, PAIR_BINS))
        share = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(share / (1 - share)))
        if 0 < y.sum() < len(y):
            self._fit(x, y)

    def bins(self, x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)], axis=1)

    def _fit(self, x: np.ndarray, y: np.ndarray) -> None:
        own, coarse = self.bins(x, self.cuts), self.bins(x, self.coarse)
        z = np.full(len(y), self.base)
        count = [np.bincount(own[:, j], minlength=BINS) for j in range(own.shape[1])]
        for _ in range(CYCLES):
            for j in range(own.shape[1]):
                p = _sigmoid(z)
                g = np.bincount(own[:, j], y - p, minlength=BINS)
                h = np.bincount(own[:, j], p * (1 - p), minlength=BINS)
                step = RATE * _tree(g, h, count[j])
                self.tables[j] += step
                z += step[own[:, j]]
        cell = lambda i, j: coarse[:, i] * PAIR_BINS + coarse[:, j]
        square = lambda c, w=None: np.bincount(c, w, minlength=PAIR_BINS**2).reshape(PAIR_BINS, -1)
        p = _sigmoid(z)
        gains = []
        for i in range(own.shape[1]):
            for j in range(i):
                c = cell(i, j)
                gains.append((_pair_tree(square(c, y - p), square(c, p * (1 - p)), square(c))[0], i, j))
        self.pairs = [(i, j) for gain, i, j in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
        self.pair_tables = np.zeros((len(self.pairs), PAIR_BINS, PAIR_BINS))
        cells = [cell(i, j) for i, j in self.pairs]
        for _ in range(CYCLES // 5):
            for k, c in enumerate(cells):
                p = _sigmoid(z)
                step = RATE * _pair_tree(square(c, y - p), square(c, p * (1 - p)), square(c))[1]
                self.pair_tables[k] += step
                z += step.ravel()[c]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        own, coarse = self.bins(x, self.cuts), self.bins(x, self.coarse)
        z = self.base + self.tables[np.arange(x.shape[1]), own].sum(axis=1)
        for k, (i, j) in enumerate(self.pairs):
            z += self.pair_tables[k, coarse[:, i], coarse[:, j]]
        return _sigmoid(z)


def _described(rows: DataFrame) -> DataFrame:
    """``rows`` with ``x``, the features, in place of ``text``."""
    keys = [c for c in rows.columns if c != "text"]
    schema = T.StructType([rows.schema[k] for k in keys]).add("x", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(x, pa.list_(pa.float64()))], names=[*keys, "x"])

    return rows.select(*keys, "text").mapInArrow(run, schema)


def fitted(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Additive:
    """The model of ``documents (doc_id, text)`` labelled in ``labels (doc_id, quality)``.

    At most ``sample`` labels are used, those with the smallest hashes of their ids, of the
    labels whose document is there; a label that is given twice counts once, and a document
    that is there twice with the least of its texts. Their ids are broadcast, their features
    (no texts) reach the driver, where the tables are fitted: both are bounded by ``sample``.
    """
    marks = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality").distinct()
    there = documents.select("doc_id").distinct()
    marks = materialised(marks.join(there, "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id")), "marks")
    chosen = lowest(marks, sample, "h", "quality")
    rows = documents.join(F.broadcast(chosen), "doc_id").groupBy("h", "doc_id", "quality").agg(F.min(text_of(F.col("text"))).alias("text"))
    found: pd.DataFrame = _described(rows.select("h", "quality", "text")).orderBy("h", "quality", "x").select("quality", "x").toPandas()
    x = np.array(found["x"].tolist(), float).reshape(-1, len(NAMES))
    return Additive(x, (found["quality"].to_numpy() == 1).astype(float))


def scored(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row a document: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Labels of held-out documents are never used. Null texts count as empty and are scored
    like any other; repeated rows are scored each.
    """
    out = held_out(documents[key], 5, 0)
    rows = documents.select(documents[key].alias("doc_id"), out.alias("held_out"), text_of(documents[text]).alias("text"))
    model = fitted(rows.where("not held_out").select("doc_id", "text"), labels)
    schema = T.StructType([rows.schema["doc_id"], rows.schema["held_out"]]).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column("text")], float).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(model(x))], names=["doc_id", "held_out", "score"])

    scores = rows.mapInArrow(run, schema)
    return scores.select("doc_id", "held_out", "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))
