"""The pipeline, stage by stage, against the brute-force versions of its operators."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from shardlog.llm import packing
from tests.llm.cases import EXTRA, awkward, documents
from tests.llm.test_packing import slow_ids
from tests.llm.test_quality import slow_counts
from tests.llm.test_simhash import slow_one_of_each

SF = "/root/testdata/sf0.001"


def stage(spark, number, docs, folder):
    path = str(folder / f"stage-{number}")
    corpus_pipeline.STAGES[number][1](spark, docs, SF).write.parquet(path)
    return spark.read.parquet(path)


def counted(df):
    return Counter(map(tuple, df.collect()))


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0d]", "", text or "")


@pytest.fixture(scope="module", params=["table", "awkward"])
def stages(request, spark, tmp_path_factory):
    """Each stage's input and output."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if request.param == "awkward":
        docs = documents(spark, [*awkward(), *((100 + i, t, lang, s) for i, t, lang, s in awkward() if i)], extra=True)
    all_ = [docs]
    for number in range(len(corpus_pipeline.STAGES)):
        all_.append(stage(spark, number, all_[-1], folder))
    return all_


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert set(EXTRA) <= set(stages[0].columns) or len(stages[0].columns) == 5


def test_quality_keeps_what_passes_the_base_rules(stages):
    want = Counter()
    for row in stages[0].collect():
        n, *_, repeated = slow_counts(row.text)
        if n >= 50 and 100 * repeated <= 50 * n:  # too few labels for a certified cutoff
            want[tuple(row)] += 1
    assert counted(stages[1]) == want


def test_exact_dedup_keeps_the_longest_and_then_the_smallest(stages):
    groups = {}
    for row in stages[1].collect():
        groups.setdefault(squeezed(row.text), []).append(row)
    want = [min(g, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id)) for g in groups.values()]
    assert counted(stages[2]) == Counter(map(tuple, want))


def test_near_dedup_keeps_the_smallest_of_each_class(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert sorted((r.doc_id for r in stages[3].collect()), key=str) == slow_one_of_each(rows)
    assert not counted(stages[3]) - counted(stages[2])


def test_mixing_repeats_whole_documents(stages):
    before, after = counted(stages[3]), counted(stages[4])
    assert set(after) <= set(before)
    tokens = lambda rows: sum(n * len((dict(zip(stages[3].columns, r, strict=True))["text"] or "").split()) for r, n in rows.items())
    if tokens(before) > 10_000:
        assert tokens(after) == pytest.approx(tokens(before), rel=0.25)


def test_packing_of_what_is_left(stages):
    want = Counter()
    for row in stages[4].collect():
        ids, start = np.array(slow_ids(row.text), "<u4"), 0
        for n in packing.lengths(len(ids)):
            want[row.doc_id, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids)] += 1
            start += n
    got = stages[5].collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    assert len({r.sequence_id for r in got}) == len(got)


def test_run_returns_packed_pieces(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.groupBy("doc_id").count().count() > 50


def test_stages_on_an_empty_table(spark):
    docs = documents(spark, [])
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, docs, SF).count() == 0
