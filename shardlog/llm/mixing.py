"""Mixing to target weights by soft membership.

A classifier fitted on a labelled table gives every document a posterior over domains.
Non-negative rates for the documents are then fitted by least squares with a ridge towards
rates of 1, so that the domains' expected tokens, rate times tokens times posterior, match
the targets, or come as near to them as the documents allow.
"""

import logging
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlog.llm import rowstore
from shardlog.llm.common import lowest, text_of
from shardlog.workdir import materialised

SURE = 2.5  # deviations from which a word's odds count
SAMPLE = 20_000  # labelled documents that the classifier is fitted on, at most
FEATURE_BITS = 14
FEATURES = 1 << FEATURE_BITS  # hashed words
AT_ONCE = 1 << 20  # bytes of text that are looked at together
ROUNDS = 40  # of projected gradient, at most; a round reads the posteriors twice
RIDGE = 1e-4  # weight of the rates' distance from 1, beside that of the shares from the targets
DAMPINGS = tuple(RIDGE * 3.0**k for k in range(10))  # tried for each step, the last beyond any curvature
NEAR = 1e-3  # rates up to here are held by their bound, where their gradient pushes them to 0
CLOSE = 1e-7  # distance of the rates from their projected gradient at which the rounds end
FAR = 0.005  # distance of a share from its target that is logged


def labelled(labels: DataFrame) -> DataFrame:
    """``(doc_id, domain)`` of the labels table: toxic, else poor where quality is 0, else good."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))


class Words:
    """Hashed features of the words of many texts at once, without a Python object a word.

    A word has two: the word itself, and its kinds of characters (each capital, each run of
    small letters), which tell markup and shouting. Words are what white space of ASCII
    divides. A hash is a polynomial in the word's bytes, modulo 2^64: a sum over bytes, taken
    for all words of a stretch of text together.
    """

    # fixed values: odd numbers without pattern
    BASE, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            inverse = pow(self.BASE, -1, 1 << 64)
            self.up, self.down = (np.cumprod(np.append(np.uint64(1), np.full(n, x, np.uint64))) for x in (self.BASE, inverse))

    def _hashed(self, values: np.ndarray, place: np.ndarray, starts: np.ndarray, kind: int) -> np.ndarray:
        """Features of the words that begin at ``starts``; ``place`` counts the bytes that take part."""
        h = np.add.reduceat(values * self.up[place], starts) * self.down[place[starts]]
        h = (h + np.uint64(kind)) * np.uint64(self.MIX)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(self.MIX)
        return (h >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)

    def _of(self, data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each word of ``data`` begins and its two features; a text begins at each of ``texts``."""
        inside = (data > 32) | (data < 9) | ((data > 13) & (data < 32))
        small = (data >= 97) & (data <= 122)
        before, small_before = np.append(False, inside[:-1]), np.append(False, small[:-1])
        before[texts] = small_before[texts] = False
        starts = np.flatnonzero(inside & ~before)
        if not len(starts):
            return starts, starts, starts
        self._powers(len(data))
        values = (data.astype(np.uint64) + np.uint64(1)) * inside
        words = self._hashed(values, np.arange(len(data)), starts, 0)
        kept = inside & ~(small & small_before)
        values = np.where(small, np.uint64(ord("x")), np.where((data >= 65) & (data <= 90), np.uint64(ord("X")), values)) * kept
        return starts, words, self._hashed(values, np.cumsum(kept) - kept, starts, 1)

    def parts(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For stretches of a column of texts: the number of the text of each word, and its two features.

        A stretch has about ``AT_ONCE`` bytes; a longer text comes in several, divided between words.
        """
        column = column.cast(pa.large_string())
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        at = first = 0
        while first < len(column):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + AT_ONCE, side="right")) - 1)
            start, end = int(ends[first]) + at, int(ends[last])
            if last == first + 1 and end - start > AT_ONCE:
                end = self._between(data, start + AT_ONCE, end)
            # empty texts begin where the next one does, so each word belongs to the last that began before it
            texts = ends[first:last] - start
            starts, words, shapes = self._of(data[start:end], texts[(texts >= 0) & (texts < end - start)])
            yield first + np.searchsorted(texts, starts, side="right") - 1, words, shapes
            at = end - int(ends[first]) if end < ends[last] else 0
            first = first if at else last

    @staticmethod
    def _between(data: np.ndarray, at: int, end: int) -> int:
        """The next white space from ``at`` on."""
        while at < end:
            some = data[at : min(end, at + 4096)]
            blank = np.flatnonzero((some == 32) | ((some >= 9) & (some <= 13)))
            if len(blank):
                return at + int(blank[0])
            at += len(some)
        return end


def _distinct(texts: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Each pair of a text and a feature once, as a sorted number ``text * FEATURES + feature``."""
    return np.unique(texts * FEATURES + features)


class Posteriors:
    """Log odds of hashed words, calibrated by a softmax on other documents.

    Half of the sample gives the log odds of each word between a domain and the rest, where
    they differ by more than ``SURE`` deviations; the other half gives the softmax over a
    document's mean, largest and summed odds. Both come from at most ``sample`` labelled
    documents of the table, those with the smallest hashes of their ids; their ids are all
    that is broadcast. A repeated id counts once, with the least of its texts. Domains without a labelled document keep a posterior of nearly zero.
    Without any label, every document has the same posterior everywhere.
    """

    def __init__(self, documents: DataFrame, labels: DataFrame, domains: list[str], sample: int = SAMPLE):
        self.domains = domains
        order = F.xxhash64("doc_id")
        present = documents.select(documents["doc_id"].alias("doc_id")).distinct()  # before the sample, which is to be full
        chosen = (
            labels.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).select("doc_id", "domain").distinct()
            .join(present, "doc_id", "left_semi").select("doc_id", "domain", order.alias("h"))
        )
        chosen = lowest(materialised(chosen, "marks"), sample, "h", "domain")
        rows = documents.select(documents["doc_id"].alias("doc_id"), text_of(documents["text"]).alias("text"))
        rows = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "domain", "h").agg(F.min("text").alias("text"))
        rows = materialised(rows.select("domain", (F.col("h") % 2 == 0).alias("first"), "text"), "labelled")
        n = len(domains)
        self.middle, self.width = np.zeros(3 * n), np.ones(3 * n)
        self.weights, self.bias = np.zeros((3 * n, n)), np.zeros(n)
        self._count(rows.where("first").select("domain", "text"))
        self._calibrate(rows.where("not first").select("domain", "text"))

    def _count(self, rows: DataFrame) -> None:
        domains = self.domains

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = Words()
            for batch in batches:
                domain = np.array([domains.index(d) for d in batch.column("domain").to_pylist()], np.int64)
                met = [_distinct(np.append(texts, texts), np.append(a, b)) for texts, a, b in words.parts(batch.column("text"))]
                met = np.unique(np.concatenate([np.zeros(0, np.int64), *met]))
                of = domain[met // FEATURES] * (FEATURES + 1) + met % FEATURES
                of = np.append(of, domain * (FEATURES + 1) + FEATURES)  # the last counts the documents
                which, n = np.unique(of, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(n)], names=["f", "n"])

        sums = rows.mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()
        own = np.zeros((len(domains), FEATURES + 1))
        for f, n in sums:  # at most domains times features rows
            own.ravel()[f] = n
        own = own.T
        of, own = own[-1], own[:-1]
        all_ = own.sum(axis=1, keepdims=True)
        prior = 2 * all_ / max(1.0, of.sum()) + 0.01
        others = all_ - own
        odds = np.log((own + prior) / (of + 3)) - np.log((others + prior) / (of.sum() - of + 3))
        deviations = odds / np.sqrt(1 / (own + prior) + 1 / (others + prior))
        self.odds = np.where(np.abs(deviations) > SURE, odds, 0.0)

    def scores(self, column: pa.Array, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """For each text and domain the mean odds of its words, the largest and the sum of those in favour; and its words."""
        n, domains = len(column), len(self.domains)
        tokens, total = np.zeros(n, np.int64), np.zeros((n, domains))
        speaks = (self.odds != 0).any(axis=1)  # most features tell nothing
        met = [np.zeros(0, np.int64)]
        for texts, *features in words.parts(column):
            if not len(texts):
                continue
            first, among = texts[0], texts[-1] - texts[0] + 1
            tokens[first : first + among] += np.bincount(texts - first, minlength=among)
            for f in features:
                said = speaks[f]
                f, of = f[said], texts[said]
                for d in range(domains):
                    total[first : first + among, d] += np.bincount(of - first, weights=self.odds[f, d], minlength=among)
                met.append(_distinct(of, f))
        met = np.unique(np.concatenate(met))
        text, favour = met // FEATURES, np.maximum(self.odds[met % FEATURES], 0.0)
        most, sums = np.zeros((n, domains)), np.zeros((n, domains))
        if len(met):
            begins = np.append(0, np.flatnonzero(np.diff(text)) + 1)
            most[text[begins]] = np.maximum.reduceat(favour, begins)
            sums[text[begins]] = np.add.reduceat(favour, begins)
        return np.concatenate([total / np.maximum(2 * tokens, 1)[:, None], most, np.log1p(sums)], axis=1), tokens

    def _calibrate(self, rows: DataFrame) -> None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = Words()
            for batch in batches:
                scores, _ = self.scores(batch.column("text"), words)
                yield pa.RecordBatch.from_arrays([batch.column("domain"), _lists(scores)], names=["domain", "s"])

        rest = rows.mapInArrow(run, "domain string, s array<double>").collect()
        if not rest:
            return
        x = np.array([r.s for r in rest])
        y = np.eye(len(self.domains))[[self.domains.index(r.domain) for r in rest]]
        self.middle, self.width = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.middle) / self.width
        self.bias = np.log(y.mean(axis=0) + 1e-3)
        for _ in range(500):
            p = _softmax(x @ self.weights + self.bias)
            self.weights -= 0.5 * (x.T @ (p - y) / len(x) + 1e-3 * self.weights)
            self.bias -= 0.5 * (p - y).mean(axis=0)

    def __call__(self, scores: np.ndarray) -> np.ndarray:
        return _softmax((scores - self.middle) / self.width @ self.weights + self.bias)

    def applied(self, rows: DataFrame, text: str) -> DataFrame:
        """``rows`` with ``tokens`` (words) and ``p``, the posterior, in place of the text."""
        keys = [c for c in rows.columns if c != text]
        schema = rows.select(*keys).schema.add("tokens", "long").add("p", T.ArrayType(T.DoubleType()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = Words()
            for batch in batches:
                scores, tokens = self.scores(batch.column(text), words)
                columns = [*(batch.column(k) for k in keys), pa.array(tokens), _lists(self(scores))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keys, "tokens", "p"])

        return rows.select(*keys, text).mapInArrow(run, schema)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(rows.ravel()))


def _matrix(batch: pa.RecordBatch, n: int) -> np.ndarray:
    return np.asarray(batch.column("p").flatten(), float).reshape(-1, n)


class Step(NamedTuple):
    """One projected-gradient step of all rates; see ``stepped``."""

    error: np.ndarray  # the distance of the shares from the targets before it
    bend: np.ndarray  # what the curvature of the free rates takes from that
    damping: float  # at least RIDGE; with more, the step is shorter and more like the gradient itself


def _free(p: np.ndarray, rate: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each rate's gradient, p . error + RIDGE * (rate - 1), and whether its bound of 0 leaves it free to follow."""
    gradient = p @ error + RIDGE * (rate - 1)
    return gradient, (rate > NEAR) | (gradient <= 0)


def stepped(p: np.ndarray, rate: np.ndarray, step: Step) -> np.ndarray:
    """Subtract the scaled gradient and project on rates of 0 and more.

    Free rates take the gradient multiplied by the inverse of their curvature, a matrix of
    the rank of p, to which ``damping`` is added: that needs ``bend`` only. Rates that their
    bound holds take it divided by 1 + RIDGE, the largest curvature there is.
    """
    gradient, free = _free(p, rate, step.error)
    scaled = (gradient - p @ step.bend) / step.damping
    return np.maximum(0.0, rate - np.where(free, scaled, gradient / (1 + RIDGE)))


def _rates(p: np.ndarray, steps: list[Step]) -> np.ndarray:
    """The rates of documents with posteriors ``p`` after ``steps``, from 1 on."""
    rate = np.ones(len(p))
    for step in steps:
        rate = stepped(p, rate, step)
    return rate


class Fit(NamedTuple):
    """``steps`` give the rates; ``error`` is what each domain's share is above its target."""

    steps: list[Step]
    error: np.ndarray


def fit(posteriors: DataFrame, targets: list[float], rounds: int = ROUNDS) -> Fit:
    """The rates that minimise |e|^2 + ``RIDGE`` * sum(tokens (rate - 1)^2) / sum(tokens), and the e that remains.

    e is the distance of the domains' shares of the tokens from the targets. Where targets
    can be met, the ridge leaves them off by about ``RIDGE`` over the domain's squared
    posteriors. Where they cannot, as in a domain that has no documents, it keeps the rates
    near 1 instead of raising whatever has the largest of the small posteriors.

    Projected gradient: every round each document's rate moves against its gradient, scaled
    as ``stepped`` tells, and is projected on 0 and more. No rates are stored: a document
    repeats the steps so far. A round is two passes over the posteriors, one for the free
    rates' curvature and one that tries the step with several dampings, of which the best is
    taken. Only sums, a few numbers for each task, reach the driver. It ends where the
    rates are those of their own projected gradient, or no step gains anything.
    """
    n = len(targets)
    goal = np.array(targets, float) / sum(targets)

    def summed(width: int, sums_of) -> np.ndarray:
        """Sums over all documents of the numbers that ``sums_of(p, tokens)`` gives, for one token."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width + 1)
            for batch in batches:
                p, t = _matrix(batch, n), np.asarray(batch.column("tokens"), float)
                total += np.append(sums_of(p, t), t.sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1)), pa.array(total)], names=["i", "x"])

        parts = posteriors.select("tokens", "p").mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x"))
        sums = np.zeros(width + 1)
        for i, x in parts.collect():
            sums[i] = x
        return sums[:-1] / max(sums[-1], 1.0)

    def tried(before: list[Step], nexts: list[Step]) -> list[tuple[float, np.ndarray]]:
        """Value and e after each of ``nexts``."""

        def sums_of(p: np.ndarray, t: np.ndarray) -> np.ndarray:
            rate = _rates(p, before)
            after = [stepped(p, rate, step) for step in nexts] or [rate]
            return np.concatenate([np.append((r * t) @ p, (t * (r - 1) ** 2).sum()) for r in after])

        rows = summed(max(1, len(nexts)) * (n + 1), sums_of).reshape(-1, n + 1)
        errors = rows[:, :n] - goal
        return [(float(e @ e + RIDGE * away) / 2, e) for e, away in zip(errors, rows[:, n], strict=True)]

    def bent(before: list[Step], error: np.ndarray) -> tuple[list[Step], float]:
        """The next step with each damping, and how far the rates are from their projected gradient."""

        def sums_of(p: np.ndarray, t: np.ndarray) -> np.ndarray:
            rate = _rates(p, before)
            gradient, free = _free(p, rate, error)
            weight = t * free
            left = (t * (rate - np.maximum(0.0, rate - gradient)) ** 2).sum()
            return np.concatenate([((p * weight[:, None]).T @ p).ravel(), (weight * gradient) @ p, [left]])

        sums = summed(n * n + n + 1, sums_of)
        curve, slope = sums[: n * n].reshape(n, n), sums[n * n : -1]
        return [Step(error, np.linalg.solve(curve + x * np.eye(n), slope), x) for x in DAMPINGS], float(np.sqrt(sums[-1]))

    steps: list[Step] = []
    value, error = tried(steps, [])[0]
    for _ in range(rounds):
        nexts, left = bent(steps, error)
        if left < CLOSE:
            break
        results = tried(steps, nexts)
        best = min(range(len(nexts)), key=lambda k: results[k][0])
        if results[best][0] >= value:
            break
        steps.append(nexts[best])
        value, error = results[best]
    if np.abs(error).max() > FAR:
        logging.getLogger(__name__).warning("shares of tokens above the targets after mixing: %s", error.round(4).tolist())
    return Fit(steps, error)


def fitted(posteriors: DataFrame, targets: list[float], rounds: int = ROUNDS) -> list[Step]:
    """What ``rated`` takes; a document's rate follows from it and its own posterior."""
    return fit(posteriors, targets, rounds).steps


def rated(posteriors: DataFrame, steps: list[Step], n: int) -> DataFrame:
    """``posteriors`` with each document's ``rate``."""
    keys = posteriors.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate = _rates(_matrix(batch, n), steps)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], names=[*keys, "rate"])

    return posteriors.mapInArrow(run, T.StructType([*posteriors.schema.fields, T.StructField("rate", T.DoubleType())]))


def with_copies(rates: DataFrame, *key: str) -> DataFrame:
    """Adds ``copies``: the rate rounded up or down by the key's hash, so that on average it is kept."""
    luck = F.pmod(F.xxhash64(*key), F.lit(1 << 30)) / float(1 << 30)
    return rates.withColumn("copies", F.floor(F.col("rate") + luck).cast("long"))


def mixture(documents: DataFrame, labels: DataFrame, targets: dict[str, float]) -> DataFrame:
    """One row a document: ``doc_id``, ``tokens``, ``p`` (in the order of ``targets``), ``rate``, ``copies``.

    ``labels`` has ``(doc_id, domain)``. Null and empty texts have no tokens and the
    posterior of a text without words. Repeated rows are rated each. An empty table gives
    no rows. A domain without documents keeps its target unmet; ``fit`` returns by how much.
    """
    model = Posteriors(documents, labels, list(targets))
    rows = documents.select(documents["doc_id"].alias("doc_id"), text_of(documents["text"]).alias("text"))
    posteriors = materialised(model.applied(rows, "text"), "posteriors")
    steps = fitted(posteriors, list(targets.values()))
    return with_copies(rated(posteriors, steps, len(targets)), "doc_id")


def mixed(documents: DataFrame, labels: DataFrame, targets: dict[str, float]) -> DataFrame:
    """The documents in the fitted mixture, each as often as its copies say."""
    model = Posteriors(documents, labels, list(targets))
    store = rowstore.stored(documents, "mix")
    rows = store.select("chunk", "pos", store["row"]["doc_id"].alias("doc_id"), text_of(store["row"]["text"]).alias("text"))
    posteriors = materialised(model.applied(rows, "text"), "posteriors")
    steps = fitted(posteriors, list(targets.values()))
    copies = with_copies(rated(posteriors, steps, len(targets)), "doc_id", "chunk", "pos")
    decided = rowstore.by_chunk(copies.select("chunk", "pos", F.col("copies").alias("value")))
    often = rowstore.with_value(store, decided, "copies").where("copies > 0")
    return rowstore.rows_of(often.select("row", F.explode(F.sequence(F.lit(1), "copies"))))
