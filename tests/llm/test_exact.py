"""Exact duplicates against grouping in plain Python."""

import hashlib
import os
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shardlog.llm import exact
from tests.llm.cases import awkward, documents

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), i is None, i))
    out = []
    for norm, found in groups.items():
        best = min(found)[2]
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, best, len(found), sha) for _, _, i in found]
    return sorted(out, key=str)


def check(df, rows):
    got = df.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == expected(rows)
    kept = [r for r in got if r.kept]
    assert all(r.doc_id == r.keep_id for r in kept)
    assert len(kept) == len({r.text_sha256 for r in kept}) == len({r.text_sha256 for r in got})


def test_awkward(spark):
    rows = awkward()
    found = exact.Duplicates(documents(spark, rows, extra=True))
    check(found.report(), [r[:2] for r in rows])
    kept = found.kept()
    assert kept.columns == documents(spark, rows, extra=True).columns
    assert len({re.sub(r"[\x20\x09-\x0d]", "", r.text or "") for r in kept.collect()}) == kept.count()


def test_empty(spark):
    found = exact.Duplicates(documents(spark, []))
    assert found.report().count() == 0 and found.kept().count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(exact.Duplicates(docs).report(), [(r.doc_id, r.text) for r in docs.collect()])


def test_hot_group_over_many_chunks(spark):
    rows = [(i, "same  text" if i % 3 else f"own {i}", "en", "a") for i in range(600)]
    docs = documents(spark, rows).repartition(20)
    check(exact.Duplicates(docs).report(), [r[:2] for r in rows])


@given(st.sets(st.integers(0, 2**63 - 1), min_size=1, max_size=300))
@settings(deadline=None)
def test_code_round_trip(values):
    values = np.array(sorted(values), np.uint64)
    low, unary, rest = exact.golomb(values)
    assert (exact.golomb_decoded(len(values), low, unary, rest) == values).all()


def test_code_is_small():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 30, 10_000).astype(np.uint64))
    _, unary, rest = exact.golomb(values)
    assert len(unary) + len(rest) < 2.4 * len(values)


@pytest.mark.parametrize("values", ([0], [0, 1, 2], [5], [2**62]))
def test_code_edges(values):
    values = np.array(values, np.uint64)
    low, unary, rest = exact.golomb(values)
    assert (exact.golomb_decoded(len(values), low, unary, rest) == values).all()
