"""Best-fit packing: large pieces in pairs first, the small ones into the tightest gaps.

A piece above a third of the capacity shares a sequence with one such piece at most, so the
large ones are matched: each, from the longest on, with the longest that fits beside it,
which makes as many pairs as there can be. The smaller ones, from the longest on, go where
the least room that suffices is left. Pieces of one length are all alike, so the plan is
made from the number of pieces of each length, a bounded table, and holds for any number of
documents. Each piece finds its place from its rank among those of its length.
"""

import codecs
import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shardlog.llm import rowstore
from shardlog.llm.packing import FLUSH, HIDDEN, Recent

CAPACITY = 1024
END = 2  # the id that closes a document
REMEMBERED = 200_000  # parts of texts whose ids a task keeps in each of two generations
AT_ONCE = 1 << 18  # characters of a text that are looked at together
# fixed values: how the tokenizer divides a text; those of ASCII and western letters need no other step
PARTS = re.compile(r" ?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\sA-Za-zªµºÀ-ÖØ-öø-ÿ0-9²³¹¼-¾]+|\s+(?!\S)|\s+")
PLAIN = re.compile(r"[\t-\r -~¡-±´-¸º»¿-ÿ]*")
# what a byte is shown as in the tokenizer's table
SHOWN = {b: 256 + i for i, b in enumerate(HIDDEN)}
BYTES = "".join(chr(SHOWN.get(b, b)) for b in range(256))
PACK = [struct.Struct(f"<{n}I").pack for n in range(256)]
BREAK = re.compile(r"(?<=[^\s]) (?=[^\s])")  # here a text can be cut, and its parts stay the same


class ByteTokenizer:
    """Ids of whole texts from the ids of their parts, some of the text at a time.

    Plain texts are divided here as the tokenizer does it, and its merge table takes the
    parts one by one; lately met ones are kept, in a bounded number. Any other text goes
    through the whole tokenizer, as does every text if its file names other steps.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.parts = Recent(self._part, REMEMBERED)
        said = json.loads(self.tokenizer.to_str())
        steps = said.get("pre_tokenizer") or {}
        known = steps.get("type") == "ByteLevel" and steps.get("use_regex", True) and not steps.get("add_prefix_space")
        self.known = known and said.get("normalizer") is None and said["model"]["type"] == "BPE" and not said["model"].get("ignore_merges")
        self.special = [t["content"] for t in said.get("added_tokens", [])]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        tokens = self.merges.tokenize(codecs.charmap_decode(part.encode(), "strict", BYTES)[0])
        ids = [t.id for t in tokens]
        return PACK[len(ids)](*ids) if len(ids) < len(PACK) else struct.pack(f"<{len(ids)}I", *ids)

    def _some(self, text: str) -> bytes:
        if PLAIN.fullmatch(text):
            return b"".join(map(self.parts.__getitem__, PARTS.findall(text)))
        return self._whole(text)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not self.known or any(s in text for s in self.special):
            return self._whole(text)
        if len(text) <= AT_ONCE:
            return self._some(text)
        made, start = [], 0
        while start < len(text):
            cut = BREAK.search(text, start + AT_ONCE)  # the space goes with what follows
            end = cut.start() if cut else len(text)
            made.append(self._some(text[start:end]))
            start = end
        return b"".join(made)


@lru_cache(maxsize=1)
def tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)


def cut(n: int, capacity: int = CAPACITY) -> list[int]:
    """The lengths of a document's pieces: full ones, and before them what is left over."""
    return ([n % capacity] if n % capacity else []) + [capacity] * (n // capacity)


class Plan:
    """Places for all pieces, from the number of pieces of each length.

    A place is a run of sequences with consecutive numbers that take ``each`` pieces of a
    length from ``offset`` on; ``first`` is the rank of the run's first piece among those of
    its length. ``sequences`` counts them all.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.sequences = capacity, 0
        self.left = {length: n for length, n in counts.items() if n > 0}
        self.given: dict[int, int] = {}
        self.places: list[tuple[int, int, int, int, int]] = []  # length, first, sequence, each, offset
        self.gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # runs of sequences by the room left
        large = sorted((x for x in self.left if 3 * x > capacity), reverse=True)
        self._match(large)
        for length in sorted((x for x in self.left if 3 * x <= capacity), reverse=True):
            self._fit(length)

    def _place(self, length: int, n: int, sequence: int, each: int, offset: int) -> None:
        first = self.given.get(length, 0)
        self.places.append((length, first, sequence, each, offset))
        self.given[length] = first + n
        self.left[length] -= n

    def _new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _match(self, large: list[int]) -> None:
        for a in large:
            for b in large:
                if self.left[a] and a + b <= self.capacity and b <= a and self.left[b]:
                    pairs = self.left[a] // 2 if a == b else min(self.left[a], self.left[b])
                    if pairs:
                        start = self._new(pairs)
                        if a == b:
                            self._place(a, 2 * pairs, start, 2, 0)
                        else:
                            self._place(a, pairs, start, 1, 0)
                            self._place(b, pairs, start, 1, a)
                        self.gaps[self.capacity - a - b].append((start, pairs))
            if n := self.left[a]:
                start = self._new(n)
                self._place(a, n, start, 1, 0)
                self.gaps[self.capacity - a].append((start, n))

    def _fit(self, length: int) -> None:
        for gap in range(length, self.capacity + 1):  # rooms that arise here are too small for another piece
            if gap == self.capacity and self.left[length]:
                needed = -(-self.left[length] // (self.capacity // length))
                self.gaps[gap].append((self._new(needed), needed))
            each = gap // length  # a sequence just used is the tightest until no further piece fits
            while self.gaps[gap] and self.left[length]:
                start, n = self.gaps[gap].pop()
                full = min(n, self.left[length] // each)
                if full:
                    self._place(length, full * each, start, each, self.capacity - gap)
                    self.gaps[gap - each * length].append((start, full))
                rest = min(self.left[length], each) if full < n else 0
                if rest:
                    self._place(length, rest, start + full, rest, self.capacity - gap)
                    self.gaps[gap - rest * length].append((start + full, 1))
                unused = n - full - bool(rest)
                if unused:
                    self.gaps[gap].append((start + n - unused, unused))

    def arrays(self) -> dict[str, np.ndarray]:
        table = np.array(sorted(self.places), np.int64).reshape(-1, 5)
        return dict(zip(("length", "first", "sequence", "each", "offset"), table.T, strict=True))


RANKS = 44  # bits for the rank of a piece among those of its length


def _pieces(documents: DataFrame, path: str, capacity: int) -> DataFrame:
    """``(doc_id, piece, start, length, ids, nth)``; ``nth`` counts pieces of one length within a task."""
    schema = documents.select("doc_id").schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids", "binary"), ("nth", "long")):
        schema = schema.add(name, kind)
    close = np.array([END], "<u4").tobytes()

    def batch_of(keys: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
        made = [pa.array(c, kind) for c, kind in zip(columns[1:], kinds, strict=True)]
        return pa.RecordBatch.from_arrays([keys.take(pa.array(columns[0], pa.int64())), *made], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, met = tokenizer(path).encode, [0] * (capacity + 1)
        for batch in batches:
            keys, rows, waiting = batch.column("doc_id"), [], 0
            for i, value in enumerate(batch.column("text")):
                ids = encode(value.as_py() or "") + close
                start = 0
                for piece, size in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((i, piece, start, size, ids[4 * start : 4 * (start + size)], met[size]))
                    met[size] += 1
                    start += size
                    waiting += size
                    if waiting >= FLUSH:
                        yield batch_of(keys, rows)
                        rows, waiting = [], 0
            yield batch_of(keys, rows)

    return documents.mapInArrow(run, schema)


def _placed(ranked: DataFrame, plan: Plan) -> DataFrame:
    """``ranked`` (length, rank) with its place; the plan is a bounded table."""
    places = plan.arrays()
    key = (places["length"] << RANKS) + places["first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            at = np.searchsorted(key, (length << RANKS) + rank, side="right") - 1
            nth, each = rank - places["first"][at], places["each"][at]
            where = [places["sequence"][at] + nth // each, places["offset"][at] + nth % each * length]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, where)], names=[*batch.schema.names, "sequence_id", "offset"])

    schema = ranked.select("*", F.col("rank").alias("sequence_id"), F.col("rank").alias("offset")).schema
    return ranked.mapInArrow(run, schema)


def pack(documents: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """One row a piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids``, ``sequence_id``, ``offset``.

    ``ids`` are the piece's token ids, little-endian unsigned 32-bit; ``path`` is the
    tokenizer's file. Each document is closed by one id more, so a null or empty text gives
    one piece of one token. Only documents longer than a sequence are cut; the first piece
    holds what full ones leave over. Long texts are divided some at a time, except where
    nothing but the whole tokenizer can. Repeated rows are packed each, an empty table gives
    no rows.

    The pieces are written once, bucketed by the task that made them. A task's pieces of one
    length are numbered there, and tasks by running sums of their counts, so that no piece
    is shuffled: what travels is one row of counts for each task.
    """
    rows = documents.select(documents[key].alias("doc_id"), documents[text].alias("text"))
    store = rowstore.stored(_pieces(rows, path, capacity), "pieces")
    lengths = store.select("chunk", store["row"]["length"].alias("length")).groupBy("chunk", "length").count()
    counts = {r.length: r.n for r in lengths.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # capacity rows at most
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = lengths.select("chunk", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    per_chunk = before.groupBy("chunk").agg(F.map_from_entries(F.collect_list(F.struct("length", "before"))).alias("before"))
    ranked = store.join(per_chunk.hint("shuffle_hash"), "chunk").select(
        "row.*", (F.element_at("before", F.col("row.length")) + F.col("row.nth")).alias("rank")
    )
    placed = _placed(ranked, Plan(counts, capacity))
    return placed.select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")
