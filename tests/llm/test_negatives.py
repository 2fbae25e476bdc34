"""Hard negatives against all scores; the intervals against the scores they bound."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shardlog.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows, share=80, k=5):
    kept = [
        (i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label)
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    score = lambda a, b: sum(x * y for x, y in zip(a[1], b[1], strict=False))
    out = []
    for a in (a for a in kept if a[0] % 100 == 0):
        others = [(score(a, b), b) for b in kept if b is not a]
        liked = sorted((-s, b[0]) for s, b in others if b[2] == a[2])[:k]
        for p, positive in liked:
            fits = sorted((-s, b[0]) for s, b in others if b[2] != a[2] and share * -p <= 100 * s <= 100 * -p)[:k]
            out += [(a[0], positive, rank, n, -p, -s) for rank, (s, n) in enumerate(fits, 1)]
    return Counter(out)


def made(n, d, seed, labels=3):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.normal(size=d).astype(np.float32)], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("n,d,labels", [(401, 8, 3), (301, 64, 2), (250, 70, 4), (201, 1, 2)])
def test_all_scores(spark, n, d, labels):
    rows = made(n, d, d, labels)
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert Counter(map(tuple, got.collect())) == slow(rows)


def test_awkward(spark):
    rng = random.Random(3)
    vectors = [[rng.choice([0.0, 0.25, 0.5, -0.5]) for _ in range(4)] for _ in range(6)]  # many ties
    rows = [(i % 150, rng.choice(vectors), rng.choice([1, 2, None])) for i in range(400)]  # repeated ids
    rows += [(None, [1.0] * 4, 1), (100, None, 1), (200, [None, 1.0, 1.0, 1.0], 1), (300, [float("nan")] * 4, 1), (400, [float("inf")] * 4, 2)]
    rows += [(500, [0.5, 0.5], 1), (600, [], 1), (600, [], 2), (700, [0.0] * 4, 1)]  # shorter ones, one without direction
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("row", "g", "s", "q", "score", "anchor", "top")})
    want = slow(rows)
    assert Counter(map(tuple, negatives.hard_negatives(df).collect())) == want
    assert want and any(p[0] == 0 for p in want)


def test_empty(spark):
    for rows in ([], [(100, [], 1), (1, [], 1), (2, [], 2)], [(100, [1.0], 1)]):
        got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA))
        assert Counter(map(tuple, got.collect())) == slow(rows)


def test_slices_of_anchors(spark, monkeypatch):
    """Several slices of anchors and small blocks of pairs give the same."""
    rows = [(100 * i if i % 2 else i, v, label) for i, v, label in made(300, 16, 5)]
    monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", 40)
    monkeypatch.setattr(negatives, "PAIRS_AT_ONCE", 100)
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA))
    assert Counter(map(tuple, got.collect())) == slow(rows)


def block(n, d, seed):
    rng = np.random.default_rng(seed)
    q = np.floor(256 * rng.normal(size=(n, d)) / np.sqrt(d)).astype("<i4")
    codes = negatives.Codes(q.astype(float), negatives.rotations(d))
    lengths = np.stack([codes.along, codes.left], axis=1).astype("<f8")
    columns = {"row": np.arange(n), "vec_id": np.arange(n), "label": rng.integers(3, size=n)}
    binary = {"q": q, "signs": codes.signs, "lengths": lengths}
    rows = pa.table(columns | {k: pa.array([x.tobytes() for x in v], pa.binary()) for k, v in binary.items()})
    return q, negatives.Block(rows, rows.slice(0, 20), d)


@pytest.mark.parametrize("d", [3, 64, 100])
def test_intervals_hold_every_score(d):
    q, b = block(300, d, d)
    i, j = np.divmod(np.arange(20 * 300), 300)
    score = (q[i].astype(np.int64) * q[j]).sum(axis=1)
    widths = []

    def useful(at, low, high):
        assert (low <= score).all() and (score <= high).all()
        widths.append((high - low).mean())
        return np.ones(len(at), bool)

    b.narrowed(i, j, useful)
    assert len(widths) == negatives.LEVELS and widths == sorted(widths, reverse=True)


def test_few_pairs_are_scored():
    _, b = block(4000, 64, 1)
    b.positives(5)
    assert b.scored < 0.1 * b.looked_at
