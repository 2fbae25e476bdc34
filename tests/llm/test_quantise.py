"""Vector codes against plain search over all entries."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardlog.llm import quantise

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows, parts=8, entries=16, rounds=6):
    kept = [
        (i, label, [int(np.floor(4096 * float(np.float32(x)))) for x in v])
        for i, v, label in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    cut = lambda v: [v[p * len(v) // parts : (p + 1) * len(v) // parts] for p in range(parts)]
    order = lambda r: (r[0] is None, r[0] or 0, np.array(r[2], "<i4").tobytes())
    start = [cut(r[2]) for r in sorted(kept, key=order)[:entries]]
    books = [[s[p] for s in start] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    find = lambda v, p: min((gap(v, c), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        held = defaultdict(list)
        for r in kept:
            for p, v in enumerate(cut(r[2])):
                held[p, find(v, p)[1]].append(v)
        for (p, e), vs in held.items():
            books[p][e] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    coded = []
    for i, label, v in kept:
        found = [find(x, p) for p, x in enumerate(cut(v))]
        coded.append((i, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    per = Counter()
    for _, label, _, error in coded:
        per[label] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return Counter((i, code, error, per[label]) for i, label, code, error in coded), digest


def check(spark, rows, extra=()):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in extra})
    got, books = quantise.compressed(df)
    found = Counter((r.vec_id, bytes(r.code).hex(), r.error, r.label_error) for r in got.collect())
    want, digest = slow(rows)
    assert found == want and books.digest() == digest


@pytest.mark.parametrize("n,d", [(300, 64), (100, 8), (40, 24), (5, 16), (1, 8)])
def test_plain_search(spark, n, d):
    rng = np.random.default_rng(n + d)
    rows = [(int(i), [float(x) for x in rng.normal(size=d).astype(np.float32)], int(rng.integers(4))) for i in rng.permutation(n)]
    check(spark, rows)


def test_awkward(spark):
    rng = np.random.default_rng(9)
    some = [[float(x) for x in rng.choice([-0.5, 0.0, 0.25], 16)] for _ in range(7)]  # ties and equal entries
    rows = [(i % 60, some[i % 7], [None, 1, 2][i % 3]) for i in range(150)]
    rows += [(None, some[0], None), (0, None, 1), (1, [None] * 16, 1), (2, [float("nan")] * 16, 1), (3, [float("-inf")] * 16, 1)]
    check(spark, rows, ("q", "code", "error", "place", "n"))


def test_other_lengths_are_left_out(spark):
    rows = [(5, [1.0] * 8, 1), (6, [0.5] * 8, 1), (7, [1.0] * 16, 1), (1, [], 1), (2, [1.0] * 7, 1)]
    got, _ = quantise.compressed(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.vec_id for r in got.collect()) == [5, 6]


def test_empty(spark):
    for rows in ([], [(1, None, 1)], [(1, [], 1)]):
        got, books = quantise.compressed(spark.createDataFrame(rows, SCHEMA))
        assert got.count() == 0 and books.digest() == hashlib.sha256(b"").hexdigest()


NUMBERS = st.integers(-5, 5)


@given(
    st.lists(st.tuples(NUMBERS, NUMBERS, NUMBERS), min_size=1, max_size=20),
    st.lists(st.tuples(NUMBERS, NUMBERS, NUMBERS), min_size=1, max_size=9),
)
@settings(deadline=None)
def test_nearest(parts, entries):
    parts, entries = np.array(parts, np.int64), np.array(entries, np.int64)
    found, best = quantise.nearest(parts, entries)
    far = ((parts[:, None] - entries) ** 2).sum(axis=2)
    assert (best == far.min(axis=1)).all() and (found == far.argmin(axis=1)).all()
