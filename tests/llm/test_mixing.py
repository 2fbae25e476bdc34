"""Mixing: the fit against plain numpy, the classifier on held-out labels."""

import os
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from shardlog.llm import mixing
from tests.llm.cases import awkward, documents, sentence

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TARGETS = {"good": 0.9, "poor": 0.07, "toxic": 0.03}


def shares(rows, weight):
    p = np.array([r.p for r in rows])
    total = (p * np.array([r.tokens * getattr(r, weight) for r in rows])[:, None]).sum(axis=0)
    return total / total.sum()


def test_whole_table_meets_the_targets(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = mixing.mixture(docs, mixing.labelled(labels), TARGETS).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    assert shares(rows, "rate") == pytest.approx(list(TARGETS.values()), abs=0.01)
    assert shares(rows, "copies") == pytest.approx(list(TARGETS.values()), abs=0.04)
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 and abs(sum(r.p) - 1) < 1e-9 for r in rows)
    domain = {r.doc_id: r.domain for r in mixing.labelled(labels).collect()}
    right = [list(TARGETS)[int(np.argmax(r.p))] == domain[r.doc_id] for r in rows if r.doc_id in domain]
    assert np.mean(right) > 0.85


def test_fit_finds_the_least_squares(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.4, 0.3, 0.2], 400)
    t = rng.integers(1, 500, 400)
    df = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(t, p, strict=True)], "tokens long, p array<double>")
    goal = np.array([0.2, 0.3, 0.5])
    rate = mixing._rates(p, mixing.fitted(df.repartition(5), list(goal)))
    assert (rate >= 0).all()
    assert (rate * t) @ p / t.sum() == pytest.approx(goal, abs=1e-3)


def plain_least_squares(p, t, goal, rounds=60_000):
    """Accelerated projected gradient with a fixed step, on rates that are all stored."""
    w = t / t.sum()
    most = np.linalg.eigvalsh((p * w[:, None]).T @ p).max() + mixing.RIDGE
    rate, ahead, k = np.ones(len(p)), np.ones(len(p)), np.sqrt(mixing.RIDGE / most)
    for _ in range(rounds):
        gradient = p @ ((ahead * w) @ p - goal) + mixing.RIDGE * (ahead - 1)
        new = np.maximum(0.0, ahead - gradient / most)
        ahead, rate = new + (1 - k) / (1 + k) * (new - rate), new
    return rate


@pytest.mark.parametrize("seed,goal", [(1, [0.2, 0.3, 0.5]), (2, [0.9, 0.05, 0.05]), (3, [0.0, 1.0, 0.0]), (4, [0.34, 0.33, 0.33])])
def test_projected_gradient_ends_at_the_least_squares(spark, seed, goal):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet([0.4, 0.3, 0.2], 300)
    p[:, 1] *= 0.2  # its largest share is out of reach
    p[:, 0] = 1 - p[:, 1:].sum(axis=1)
    t = rng.integers(1, 500, 300)
    df = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(t, p, strict=True)], "tokens long, p array<double>")
    found = mixing.fit(df.repartition(3), goal)
    rate, want = mixing._rates(p, found.steps), plain_least_squares(p, t, np.array(goal))
    assert rate == pytest.approx(want, abs=1e-6)
    assert (rate * t) @ p / t.sum() == pytest.approx((want * t) @ p / t.sum(), abs=5e-4)
    assert len(found.steps) < mixing.ROUNDS


def slow_features(text):
    """Words by white space of ASCII, their kinds of characters."""
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text or "") if w]
    return words, [re.sub("[a-z]+", "x", re.sub("[A-Z]", "X", w)) for w in words]


@pytest.mark.parametrize("at_once", [1 << 20, 40, 7])
def test_features_are_those_of_the_words(monkeypatch, at_once):
    """Equal words have equal features wherever they stand, other words have others."""
    monkeypatch.setattr(mixing, "AT_ONCE", at_once)
    texts = ["", "one Two  two\nONE", "one", "", "x" * 50 + " é one\x1cx Two", " \t", "a1b2 A1B2 a1b2 \U0001f600", "one"]
    column = pa.array(["skipped", *texts]).slice(1)
    found = [(int(i), a, b) for t, *f in mixing.Words().parts(column) for i, a, b in zip(t, *f, strict=True)]
    words, shapes = zip(*map(slow_features, texts), strict=True)
    assert [i for i, *_ in found] == [i for i, w in enumerate(words) for _ in w]
    for k, want in ((1, words), (2, shapes)):
        names = [x for part in want for x in part]
        assert len(set(zip(names, (f[k] for f in found), strict=True))) == len(set(names)) == len({f[k] for f in found})


def test_scores_are_those_of_the_words():
    model = object.__new__(mixing.Posteriors)
    model.domains, rng = ["a", "b"], np.random.default_rng(4)
    model.odds = np.where(rng.random((mixing.FEATURES, 2)) < 0.5, rng.normal(size=(mixing.FEATURES, 2)), 0.0)
    texts = ["", *(sentence(i, 1 + 37 * i).replace("a", "A", i) for i in range(9)), "one one one"]
    scores, tokens = model.scores(pa.array(texts), mixing.Words())
    for text, got, n in zip(texts, scores, tokens, strict=True):
        parts = list(mixing.Words().parts(pa.array([text])))
        f = np.concatenate([np.zeros(0, int), *(x for _, *both in parts for x in both)])
        assert n == len(text.split())
        favour = np.maximum(model.odds[np.unique(f)], 0)
        want = [model.odds[f].mean(axis=0), favour.max(axis=0), np.log1p(favour.sum(axis=0))] if len(f) else [np.zeros(6)]
        assert got == pytest.approx(np.concatenate(want))


def test_domain_without_documents_leaves_the_others_in_place(spark):
    rng = np.random.default_rng(5)
    toxic = rng.random(3000) < 0.1
    poor = rng.gamma(0.3, 0.001, 3000)
    p = np.stack([np.where(toxic, 0.03, 0.97) - poor / 2, poor, np.where(toxic, 0.97, 0.03) - poor / 2], axis=1)
    t = rng.integers(50, 900, 3000)
    df = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(t, p, strict=True)], "tokens long, p array<double>")
    goal = [0.95, 0.03, 0.02]
    found = mixing.fit(df.repartition(5), goal)
    rate = mixing._rates(p, found.steps)
    assert (rate * t) @ p / t.sum() - goal == pytest.approx(found.error, abs=1e-6)
    assert found.error[1] == pytest.approx(-0.03, abs=0.002)
    assert rate.max() < 3 and (rate[~toxic] > 0.5).all()
    assert abs(found.error[0]) < 0.02 and abs(found.error[2]) < 0.02
    assert (rate.sum() / len(rate)) == pytest.approx(1, abs=0.1)


def test_sample_is_of_documents_that_are_there_once_each(spark):
    class Counted(mixing.Posteriors):
        n = 0

        def _count(self, rows):
            self.n += rows.count()

        _calibrate = _count

    docs = documents(spark, [*((i, f"text {i}", None, None) for i in range(40)), *((7, f"hot {i}", None, None) for i in range(300))])
    labels = spark.createDataFrame([(i, "good") for i in (*range(40), 7, 7, *range(1000, 9000))], "doc_id long, domain string")
    assert Counted(docs, labels, ["good", "poor"], sample=1000).n == 40
    assert Counted(docs, labels, ["good", "poor"], sample=30).n == 30


def test_pipeline_names_all_domains():
    assert corpus_pipeline.TARGETS == {"good": 0.95, "poor": 0.03, "toxic": 0.02}


def test_awkward(spark):
    labels = spark.createDataFrame([(4, "good"), (4, "good"), (5, "poor"), (None, "good"), (16, None), (99, "toxic"), (8, "other")], "doc_id long, domain string")
    docs = documents(spark, awkward(), extra=True)
    rows = mixing.mixture(docs, labels, TARGETS).collect()
    assert len(rows) == len(awkward()) and all(np.isfinite(r.rate) and r.copies >= 0 for r in rows)
    assert mixing.mixed(docs, labels, TARGETS).columns == docs.columns


def test_without_labels_and_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, domain string")
    docs = documents(spark, awkward())
    rows = mixing.mixture(docs, labels, TARGETS).collect()
    assert len({tuple(r.p) for r in rows}) == 1
    assert mixing.mixture(documents(spark, []), labels, TARGETS).count() == 0
    assert mixing.mixed(documents(spark, []), labels, TARGETS).count() == 0


def test_copies_follow_the_rates(spark):
    df = spark.range(20_000).selectExpr("id as doc_id", "cast(id % 3 as double) * 0.7 as rate")
    got = mixing.with_copies(df, "doc_id").groupBy("rate").avg("copies").collect()
    assert all(abs(r["avg(copies)"] - r.rate) < 0.03 for r in got)
