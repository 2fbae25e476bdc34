"""Best-fit packing against the whole tokenizer and against packing piece by piece."""

import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shardlog.llm import bestfit
from tests.llm.cases import awkward, documents, sentence

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def slow_ids(text, tokenizer=Tokenizer.from_file(PATH)):  # noqa: B008
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def slow_sequences(lengths, capacity):
    """The number of sequences when every piece is placed by itself."""
    large = sorted((x for x in lengths if 3 * x > capacity), reverse=True)
    room = []
    while large:
        a = large.pop(0)
        b = next((x for x in large if a + x <= capacity), 0)
        if b:
            large.remove(b)
        room.append(capacity - a - b)
    for x in sorted((x for x in lengths if 3 * x <= capacity), reverse=True):
        fits = [g for g in room if g >= x]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - x)
        else:
            room.append(capacity - x)
    return len(room)


def check(got, rows, capacity=1024):
    want = []
    for doc, text in rows:
        ids = np.array(slow_ids(text), "<u4")
        start, first = 0, len(ids) % capacity
        sizes = [first] * bool(first) + [capacity] * (len(ids) // capacity)
        for piece, n in enumerate(sizes):
            want.append((doc, piece, start, n, zlib.crc32(ids[start : start + n].tobytes())))
            start += n
    assert Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in got) == Counter(want)
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= capacity
    assert len(held) == slow_sequences([w[3] for w in want], capacity)


def test_awkward(spark):
    rows = awkward() + [(20, sentence(5, 700), "en", "a")] * 3
    check(bestfit.pack(documents(spark, rows, extra=True), PATH).collect(), [r[:2] for r in rows])


def test_empty(spark):
    assert bestfit.pack(documents(spark, []), PATH).count() == 0


def test_other_capacity(spark):
    rows = [(i, sentence(i, 1 + i % 40), "en", "a") for i in range(300)]
    check(bestfit.pack(documents(spark, rows).repartition(5), PATH, capacity=64).collect(), [r[:2] for r in rows], 64)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(bestfit.pack(docs, PATH).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_no_piece_is_shuffled(spark):
    from tests.util import plan_of

    plan = plan_of(bestfit.pack(documents(spark, awkward()), PATH))
    assert "ids" not in "".join(part for part in plan.split("\n\n") if "Exchange" in part.split("\n")[0])


@pytest.mark.parametrize("seed", range(12))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 3, 7, 30, 100])
    counts = {x: rng.choice([0, 1, 2, 5, 9]) for x in range(1, capacity + 1)}
    plan = bestfit.Plan(dict(counts), capacity)
    room = Counter()
    filled = defaultdict(list)
    for x, first, sequence, each, offset in plan.places:
        n = min([f for y, f, *_ in plan.places if y == x and f > first], default=counts[x]) - first
        for k in range(n):
            filled[sequence + k // each].append((offset + k % each * x, x))
            room[x] += 1
    assert room == Counter({x: n for x, n in counts.items() if n})
    for places in filled.values():
        end = 0
        for offset, x in sorted(places):
            assert offset == end
            end += x
        assert end <= capacity
        assert sum(3 * x > capacity for _, x in places) <= 2
    assert len(filled) == plan.sequences == slow_sequences([x for x, n in counts.items() for _ in range(n)], capacity)


def test_plan_does_not_grow_with_the_corpus():
    small = bestfit.Plan({x: 3 for x in range(1, 1025)})
    large = bestfit.Plan({x: 3_000_000 + x for x in range(1, 1025)})
    assert len(large.places) < 3 * len(small.places) < 30_000


BLANKS = st.sampled_from([" ", "\n", "  ", "\x1c", "\x85", "　", "\xa0", "'s", "'", "<|endoftext|>", "́", "²", "ª", "é", "1", "!"])


@given(st.lists(st.one_of(BLANKS, st.text(max_size=6)), max_size=30).map("".join))
@settings(deadline=None, max_examples=300)
def test_parts_give_the_ids_of_the_text(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = bestfit.tokenizer(PATH).encode(text)
    assert [*np.frombuffer(ids, "<u4"), 2] == slow_ids(text)


@given(st.lists(st.one_of(BLANKS, st.sampled_from(["one", "two", " three", "é"])), max_size=60).map("".join))
@settings(deadline=None, max_examples=200)
def test_long_texts_are_cut_where_parts_end(text):
    before, bestfit.AT_ONCE = bestfit.AT_ONCE, 5
    try:
        ids = bestfit.tokenizer(PATH).encode(text)
    finally:
        bestfit.AT_ONCE = before
    assert [*np.frombuffer(ids, "<u4"), 2] == slow_ids(text)


def test_another_tokenizer_is_used_as_it_is():
    path = public_tokenizers.path("word_bpe_49k.json")
    text = "One, two  three's\n4 Ünder"
    assert [*np.frombuffer(bestfit.ByteTokenizer(path).encode(text), "<u4")] == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_parts_of_odd_texts_are_those_of_the_tokenizer():
    mine = bestfit.ByteTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["", " ", "  ", " a", "a ", "a  b", "a \nb", "a\n b", "x\n\ny z", "don't we'll 'tis ' d", "a\tb c", " 12 a3 ,b's"]
    texts += ["é ü çx ª²", "\n", " \n ", "a.b, c!! d", "z" * 3000 + " " + "1" * 700, "ÿ" * 400]
    assert [mine.encode(t) for t in texts] == [mine._whole(t) for t in texts]
