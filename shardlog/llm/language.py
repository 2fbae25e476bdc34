"""Language identification by n-grams in bit-sliced Bloom filters.

One table of slots serves all languages: a slot holds a bit for each language, and the
languages that contain an n-gram are the bits common to its slots. A text's language is
the one that contains most of its n-grams, after the filters' chance hits are taken off.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlog.llm.common import text_of
from shardlog.workdir import materialised

SAMPLE = 2000  # documents of a language that its filter is filled from, give or take a few hundred
SLOTS = 20  # as a power of two
SIZES = (3, 4)  # of n-grams, in characters
SHARE = 0.01  # of its sampled documents in which an n-gram must occur to belong to a language
WORD = 32  # languages in one number of a slot
# fixed values: odd multipliers, one a hash function, and the base of n-gram numbers
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
BASE = 0x100000001B3


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of lower-cased texts as numbers, and the text each comes from.

    ASCII characters other than letters count as one blank; blanks frame each text.
    """
    codes = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le"), "<u4") for t in texts]
    lengths = np.array([len(c) for c in codes], np.int64)
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    code = np.concatenate(codes).astype(np.uint64)
    code[(code < 97) | ((code > 122) & (code < 128))] = 32
    owner = np.repeat(np.arange(len(texts)), lengths)
    numbers, owners = [], []
    for size in SIZES:
        if len(code) < size:
            continue
        n = len(code) - size + 1
        number = np.full(n, size, np.uint64)
        for i in range(size):
            number = number * np.uint64(BASE) + code[i : i + n]
        inside = owner[:n] == owner[size - 1 :]
        numbers.append(number[inside])
        owners.append(owner[:n][inside])
    if not numbers:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(numbers), np.concatenate(owners)


def slots_of(number: np.ndarray) -> list[np.ndarray]:
    number = number ^ (number >> np.uint64(29))
    return [(number * np.uint64(m)) >> np.uint64(64 - SLOTS) for m in MIX]


class Filters:
    """The filters of all languages in ``rows (lang, text, h)``.

    Of each language about ``sample`` documents are taken (all, if it has no more): the
    share of ids whose hash ``h`` is low enough, of the (estimated) number of its ids. An id
    that is there more than once counts once, with the least of its texts.
    An n-gram belongs to it when at least ``SHARE`` of them, and two, have it. The slots are
    combined by Spark; the driver gets at most one row for each slot and 32 languages, and
    the names of the languages, which are as few as the world's.
    """

    def __init__(self, rows: DataFrame, sample: int = SAMPLE):
        known = materialised(rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("known")), "languages")
        share = F.shiftrightunsigned("h", 11) / float(1 << 53)
        chosen = rows.join(known, "lang").where(share <= sample / F.col("known"))
        # copies of an id are combined where they lie, before their texts travel
        chosen = materialised(chosen.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text"), "sample")
        sizes = chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
        self.languages = sorted(r.lang for r in sizes.select("lang").collect())
        number = {lang: i for i, lang in enumerate(self.languages)}

        def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    found = np.unique(grams([text])[0]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found)], names=["lang", "gram"])

        counted = chosen.mapInArrow(distinct, "lang string, gram long").groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n"))
        least = F.greatest(F.lit(2), F.ceil(SHARE * F.col("docs")))
        own = counted.join(sizes, "lang").where((F.col("n") >= least) | (F.col("n") == F.col("docs"))).select("lang", "gram")

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                which = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
                for slot in slots_of(batch.column("gram").to_numpy().view(np.uint64)):
                    columns = [slot.astype(np.int64), which // WORD, np.left_shift(1, which % WORD)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["slot", "word", "bits"])

        filled = own.mapInArrow(placed, "slot long, word long, bits long").groupBy("slot", "word").agg(F.bit_or("bits").alias("bits"))
        self.table = np.zeros((-(-max(1, len(self.languages)) // WORD), 1 << SLOTS), np.uint32)
        filled = filled.toPandas()
        self.table[filled["word"], filled["slot"]] = filled["bits"]
        full = [np.mean(self.table[i // WORD] >> np.uint32(i % WORD) & 1) for i in range(len(self.languages))]
        self.chance = np.array(full) ** len(MIX)

    def hits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text the n-grams that each language contains, less chance hits, and all its n-grams."""
        number, owner = grams(texts)
        slots = slots_of(number)
        all_ = np.bincount(owner, minlength=len(texts))
        counts = np.zeros((len(texts), len(self.languages)))
        for word, table in enumerate(self.table):
            bits = table[slots[0]]
            for s in slots[1:]:
                bits &= table[s]
            for i in range(word * WORD, min(len(self.languages), (word + 1) * WORD)):
                counts[:, i] = np.bincount(owner[(bits >> np.uint32(i % WORD) & 1).astype(bool)], minlength=len(texts))
        return np.maximum(0.0, (counts - all_[:, None] * self.chance) / (1 - self.chance)), all_

    def predicted(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``lang_pred`` and ``score`` in place of ``text``; the first of equals wins.

        The score is the winner's part of all languages' hits, 0 where nothing is known.
        """
        keys = [c for c in rows.columns if c != "text"]
        schema = T.StructType([rows.schema[k] for k in keys]).add("lang_pred", "string").add("score", "double")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, hits, waiting, begin = batch.column("text").to_pylist(), [], 0, 0
                for i, text in enumerate(texts, 1):  # about a million characters at a time
                    waiting += len(text)
                    if waiting > 1 << 20 or i == len(texts):
                        hits.append(self.hits(texts[begin:i])[0])
                        waiting, begin = 0, i
                found = np.concatenate(hits) if hits else np.zeros((0, len(self.languages)))
                best = found.argmax(axis=1) if len(self.languages) else np.zeros(len(texts), int)
                total = found.sum(axis=1)
                score = np.where(total > 0, found.max(axis=1, initial=0.0) / np.where(total > 0, total, 1), 0.0)
                names = [self.languages[b] if self.languages else None for b in best]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k) for k in keys), pa.array(names, pa.string()), pa.array(score)], names=[*keys, "lang_pred", "score"]
                )

        return rows.select(*keys, "text").mapInArrow(run, schema)


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether the crc32 of the key as text has this remainder; rows without a key are not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def languages(documents: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """One row a document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``.

    Filters are filled from documents with a language and a key that are not held out.
    Null texts and texts without a letter are ``und`` with score 0; so are all texts where
    no language is known. Repeated rows are predicted each.
    """
    out = held_out(documents[key], 4, 2)
    rows = documents.select(documents[key].alias("doc_id"), out.alias("held_out"), documents[text].alias("text"), documents[lang].alias("lang"))
    known = rows.where("not held_out and lang is not null and doc_id is not null and text is not null")
    filters = Filters(known.select("lang", "text", F.xxhash64("doc_id").alias("h")))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    asked = rows.select("doc_id", "held_out", lettered.alias("lettered"), text_of(F.col("text")).alias("text"))
    sure = F.col("lettered") & F.col("lang_pred").isNotNull()
    return filters.predicted(asked).select(
        "doc_id", "held_out", F.when(sure, F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(sure, F.col("score")).otherwise(0.0).alias("score"),
    )
