"""Quality rules against plain Python; the binomial bound against exact sums."""

import os
import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from shardlog.llm import quality
from tests.llm.cases import awkward, documents, sentence

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def check(got, rows):
    want = []
    for i, t in rows:
        n, *_, repeated = counts = slow_counts(t)
        want.append((i, *counts, n < 50 or 100 * repeated > 50 * n))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == sorted(want, key=str)
    assert not any(r.base_failed and r.kept for r in got)


def test_awkward(spark):
    rows = awkward()
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (None, 1, 0), (5, None, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows, extra=True)
    got = quality.quality_rules(docs, labels).collect()
    check(got, [r[:2] for r in rows])
    kept = quality.passing(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in got) == sum(not r.base_failed for r in got)  # too few labels for more


def test_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.quality_rules(documents(spark, []), labels).count() == 0
    assert quality.passing(documents(spark, []), labels).count() == 0


def test_whole_table(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    check(quality.quality_rules(docs, labels).collect(), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("k,n,p", [(0, 1, 0.3), (0, 700, 0.01), (3, 1000, 0.01), (9, 1000, 0.01), (40, 20_000, 0.004), (0, 5, 0.5)])
def test_binomial(spark, k, n, p):
    got = spark.range(1).select(quality.binomial_at_most(F.lit(k), F.lit(n), p)).first()[0]
    q = Fraction(p)
    want = float(sum(comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1)))
    assert got == pytest.approx(want, rel=1e-9)


def test_certified_cutoffs_find_junk_and_keep_good(spark):
    """With enough labels, junk that the base rules pass is rejected and the promise holds."""
    rows, labels = [], []
    for i in range(6000):
        bad = i % 6 == 0
        words = sentence(i, 55).split()
        rows.append((i, " ".join(w + "###" if bad else w for w in words), "en", "a"))
        labels.append((i, int(not bad), 0))
    docs = documents(spark, rows)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in quality.quality_rules(docs, table).collect()}
    good = [got[i] for i in got if i % 6]
    assert sum(not k for k in good) <= quality.ALPHA * len(good)
    assert not any(got[i] for i in got if i % 6 == 0)


def test_path_is_nested():
    for cuts in quality.PATH.values():
        assert len(cuts) == quality.LEVELS and cuts == sorted(cuts, reverse=True) and cuts[0] == quality.LOOSEST


def slow_levels(rows):
    """``(stratum, good, level)`` rows: the level chosen for each stratum, one exact test after the other."""
    strata = {s for s, *_ in rows}
    chosen = {}
    for s in strata:
        good = [r for x, g, r in rows if x == s and g]
        bad = [r for x, g, r in rows if x == s and not g]
        best = None
        for j in range(quality.LEVELS):
            k, n, p = sum(r <= j for r in good), len(good), Fraction(quality.ALPHA)
            chance = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            if k >= n * quality.ALPHA or chance > Fraction(quality.DELTA) / len(strata):
                break
            gain = sum(r <= j for r in bad) / max(1, len(bad)) - quality.COST * k / n
            if gain > 0 and (best is None or gain > best[0]):
                best = gain, j
        if best:
            chosen[s] = best[1]
    return chosen


def test_levels_of_planted_strata(spark):
    """Strata with too few labels, without bad ones, with bad ones at several levels and with good ones among them."""
    cut = quality.PATH["symbols"]
    at = lambda j: cut[j] + 1
    plan = {  # good and bad documents by the share of symbols
        "few": ([0] * 200, [900] * 50),
        "clean": ([0] * 250, []),
        "early": ([0] * 300, [900] * 30 + [at(5)] * 20),
        "mixed": ([0] * 900 + [at(9)] * 4 + [at(11)] * 40, [at(3)] * 30 + [at(8)] * 30 + [at(10)] * 30 + [at(12)] * 30),
        "dirty": ([0] * 200 + [900] * 50, [900] * 50),
    }
    rows, marks, flat, i = [], [], [], 0
    for stratum, kinds in plan.items():
        for good, shares in zip((1, 0), kinds, strict=True):
            for share in shares:
                rows.append((i, stratum, 100, 1000, share, 0, 5, 0, 0, 0))
                marks.append((i, good))
                flat.append((stratum, good, next((j for j, c in enumerate(cut) if share > c), quality.LEVELS)))
                i += 1
    for share in (900,) * 90:  # rejected by the base rules, so no level rejects them
        rows.append((i, "early", 20, 1000, share, 0, 5, 0, 0, 0))
        marks.append((i, 1))
        flat.append(("early", 1, quality.LEVELS))
        i += 1
    counted = spark.createDataFrame(rows, "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in quality.COUNTS))
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    got = {r.stratum: r.level for r in quality.cutoffs(counted, labels).collect()}
    assert got == slow_levels(flat)
    assert "few" not in got and "clean" not in got and "dirty" not in got
    assert got["early"] == 5 and 8 <= got["mixed"] < 11


def test_levels_of_a_document(spark):
    row = lambda **c: tuple(c.get(x, 1000 if x in ("n_words", "word_chars", "n_lines") else 0) for x in quality.COUNTS)
    rows = [row(), row(n_symbols=701), row(n_symbols=700), row(n_repeat_words=701, n_symbols=11), row(n_symbols=10, n_shouts=10), row(n_words=0, word_chars=0, n_lines=0)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in quality.COUNTS))
    top = quality.LEVELS
    assert [r.l for r in df.select(quality.level().alias("l")).collect()] == [top, 0, 1, 0, top, top]
