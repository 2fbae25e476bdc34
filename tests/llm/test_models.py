"""Language filters and the additive model: held-out accuracy, and their parts."""

import os
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shardlog.llm import additive, language
from shardlog.llm.common import lowest
from tests.llm.cases import awkward, documents

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = {r.doc_id: r for r in docs.collect()}
    got = language.languages(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(known)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == known[r.doc_id].lang for r in got if r.held_out]) > 0.98


def test_other_columns_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = language.held_out(F.col("doc_id"), 4, 2)
    changed = docs.withColumn("lang", F.when(~out, F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    rows = lambda d: sorted((r.doc_id, r.lang_pred, r.score) for r in language.languages(d).collect())
    assert rows(docs) == rows(changed)


def test_awkward_languages(spark):
    docs = documents(spark, awkward(), extra=True)
    got = language.languages(docs).collect()
    assert len(got) == len(awkward())
    none = {r.doc_id for r in got if r.lang_pred == "und"}
    assert none == {1, 2, 3, None, 10, 15} or none == {1, 2, 3, 10, 15, None}
    unknown = language.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}
    assert language.languages(documents(spark, [])).count() == 0


def test_filters_return_every_language_of_a_gram(spark):
    rows = [(f"l{i:02}", f"shared {chr(97 + i % 26) * 5}{chr(97 + i // 26)}", i) for i in range(70)]
    filters = language.Filters(spark.createDataFrame(rows, "lang string, text string, h long"))
    assert len(filters.languages) == 70
    hits, _ = filters.hits(["shared", "ccccc"])
    assert (hits[0] > 6).all()
    assert set(np.argsort(-hits[1], kind="stable")[:3]) == {2, 28, 54}


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id: r.quality for r in labels.collect()}
    got = additive.scored(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert np.mean([r.predicted == good[r.doc_id] for r in got if r.held_out and r.doc_id in good]) > 0.95


def test_awkward_quality(spark):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None), (99, 0), (16, 0), (8, 1)], "doc_id long, quality int")
    docs = documents(spark, awkward(), extra=True)
    got = additive.scored(docs, labels).collect()
    assert len(got) == len(awkward()) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in additive.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert additive.scored(documents(spark, []), labels).count() == 0


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = additive.Additive(x[:3000], y[:3000])
    assert np.mean((model(x[3000:]) > 0.5) == y[3000:]) > 0.9
    assert (1, 0) in model.pairs


def test_features_of_a_text():
    found = dict(zip(additive.NAMES, additive.features("A b c.\nA b c.\n!!"), strict=True))
    assert found["dup_lines"] == 1 - 2 / 3 and found["repeats"] == 6 / 7 and found["capitals"] == 2 / 10
    assert additive.features(" \n") == [0.0] * len(additive.NAMES)


def test_quality_sample_is_of_labels_that_can_be_used(spark, monkeypatch):
    """Labels of absent and held-out documents take no room, an id that comes often counts once."""
    used = []

    class Counted(additive.Additive):
        def __init__(self, x, y):
            used.append(len(y))
            super().__init__(x, y)

    monkeypatch.setattr(additive, "Additive", Counted)
    docs = documents(spark, [(i, f"some text {i} " * 9, "en", "a") for i in range(300)] + [(7, f"hot {i}", "en", "a") for i in range(500)])
    labels = spark.range(400_000).selectExpr("id * 1000 + 1 as doc_id", "cast(id % 2 as int) as quality").union(
        spark.createDataFrame([(i, i % 2) for i in (*range(300), 7, 7, 7)], "doc_id long, quality int")
    )
    additive.scored(docs, labels)
    out = sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in range(300))
    assert used == [300 - out + (1 if zlib.crc32(b"1") % 5 else 0)]  # number 1 is labelled with both kinds


def test_language_sample_is_bounded(spark, monkeypatch):
    sizes = []

    def counted(df, name, write=language.materialised):
        df = write(df, name)
        if name == "sample":
            sizes.append(df.groupBy("lang").count().collect())
        return df

    monkeypatch.setattr(language, "materialised", counted)
    ids = spark.range(1000).selectExpr("'a' as lang", "concat('text ', id) as text", "xxhash64(id) as h")
    hot = spark.range(50_000).selectExpr("'a' as lang", "concat('hot ', id % 3) as text", "xxhash64(5L) as h")
    filters = language.Filters(ids.union(hot).union(ids.selectExpr("'b'", "text", "h")), sample=200)
    assert filters.languages == ["a", "b"]
    assert all(140 < r["count"] < 260 for r in sizes[0])


def slow_grams(text):
    """Every n-gram of a framed text, ASCII other than letters as blanks."""
    text = "".join(" " if ord(c) < 128 and not "a" <= c <= "z" else c for c in f" {text.lower()} ")
    return [text[i : i + n] for n in language.SIZES for i in range(len(text) - n + 1)]


def test_languages_like_plain_sets_of_grams(spark):
    """The filters against whole sets: the same prediction wherever sets leave no doubt."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    own = {}
    for r in rows:
        if r.text and r.lang and not out(r.doc_id):
            own.setdefault(r.lang, []).append(set(slow_grams(r.text)))
    sets = {}
    for lang, docs_ in own.items():
        n = Counter(g for d in docs_ for g in d)
        sets[lang] = {g for g, k in n.items() if k >= max(2, language.SHARE * len(docs_)) or k == len(docs_)}
    predicted = {r.doc_id: r for r in language.languages(docs).collect()}
    for r in rows[::4]:
        grams = slow_grams(r.text or "")
        hits = sorted(((sum(g in s for g in grams), lang) for lang, s in sets.items()), reverse=True)
        if predicted[r.doc_id].lang_pred != "und" and hits[0][0] > 1.05 * hits[1][0] + 5:
            assert predicted[r.doc_id].lang_pred == hits[0][1]
            assert abs(predicted[r.doc_id].score - hits[0][0] / sum(h for h, _ in hits)) < 0.02


def test_scores_are_sums_of_table_entries():
    """Vectorised additions against a loop over features and pairs."""
    rng = np.random.default_rng(2)
    x = rng.random((600, 4))
    model = additive.Additive(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0.8).astype(float))
    assert model.pairs
    for row, got in zip(x[:50], model(x[:50]), strict=True):
        z = model.base
        for j, value in enumerate(row):
            z += model.tables[j][sum(c <= value for c in model.cuts[j])]
        for k, (i, j) in enumerate(model.pairs):
            z += model.pair_tables[k][sum(c <= row[i] for c in model.coarse[i])][sum(c <= row[j] for c in model.coarse[j])]
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-9


def test_lowest_hashes(spark):
    df = spark.range(5000).selectExpr("id", "xxhash64(id) as h")
    want = [r.id for r in df.orderBy("h").collect()]
    for sample in (1, 10, 700, 4499, 4500, 4999, 5000, 6000):
        assert [r.id for r in lowest(df, sample, "h").collect()] == want[:sample]
    assert lowest(df.limit(0), 5, "h").count() == 0
