"""Packing against the tokenizer applied to whole texts."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shardlog.llm import packing
from tests.llm.cases import awkward, documents

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
PATH = public_tokenizers.path("word_bpe_49k.json")


def slow_ids(text, tokenizer=Tokenizer.from_file(PATH)):  # noqa: B008
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, rows):
    got = pieces.collect()
    assert len({r.sequence_id for r in got}) == len(got) and {r.offset for r in got} <= {0}
    assert all(r.length & (r.length - 1) == 0 and 1 <= r.length <= 2048 for r in got)
    by_length = sorted((r.sequence_id, r.length) for r in got)
    assert [x for _, x in by_length] == sorted(x for _, x in by_length)  # a length is one range of numbers
    want = []
    for doc, text in rows:
        ids = np.array(slow_ids(text), "<u4")
        start = 0
        for n in packing.lengths(len(ids)):
            want.append((doc, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids)))
            start += n
        assert start == len(ids)
    assert sorted(((r.doc_id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens) for r in got), key=str) == sorted(want, key=str)


def test_awkward(spark):
    rows = awkward()
    check(packing.pack(documents(spark, rows, extra=True), PATH), [r[:2] for r in rows])


def test_empty(spark):
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(packing.pack(docs, PATH), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("n,want", [(1, [1]), (2048, [2048]), (4099, [2048, 2048, 2, 1]), (2047, [1 << b for b in range(10, -1, -1)])])
def test_lengths(n, want):
    assert packing.lengths(n) == want


BLANKS = st.sampled_from([" ", "\n", "\x1c", "\x85", "　", "\xa0", "​", "'s", "<|endoftext|>", "́", "Σ", "İ", "é"])


@given(st.lists(st.one_of(BLANKS, st.text(max_size=6)), max_size=30).map("".join))
@settings(deadline=None, max_examples=300)
def test_words_give_the_ids_of_the_text(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = packing.tokenizer(PATH).encode(text)
    assert [*np.frombuffer(ids, "<u4"), 1] == slow_ids(text)


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    tokenizer = packing.WordTokenizer(PATH)
    for text in ("one two three four", "four five one", "x" * 100 + " one", "one " + "x" * 100, "two three") * 2:
        assert [*np.frombuffer(tokenizer.encode(text), "<u4"), 1] == slow_ids(text)


def test_buckets(spark, tmp_path):
    packing.write_buckets(packing.pack(documents(spark, awkward()), PATH), str(tmp_path / "b"))
    assert all(name.startswith(("length=", "_SUCCESS", ".")) for name in os.listdir(tmp_path / "b"))


def test_another_tokenizer_is_used_as_it_is():
    assert packing.WordTokenizer(PATH).known
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "One, two  three's\n4 Ünder"
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert [*np.frombuffer(packing.WordTokenizer(path).encode(text), "<u4")] == want
