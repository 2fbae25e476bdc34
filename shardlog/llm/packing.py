"""Packing without padding: documents cut into pieces whose lengths are powers of two.

A document of n tokens gives as many full sequences as fit and one piece for each binary
digit of the rest. A piece is a sequence of its own, so none crosses documents, and equal
lengths form one bucket for training batches of one shape.
"""

import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

LENGTH = 2048
END = 1  # the id that closes a document
REMEMBERED = 200_000  # parts of texts whose ids a task keeps in each of two generations
LONGEST = 64  # letters of a word that is kept
FLUSH = 1 << 20  # tokens in one returned batch, about
# fixed values: split as white space by str.split, but not by the tokenizer
NOT_BLANK = "\x1c\x1d\x1e\x1f"
# fixed values: how the tokenizer divides a lower-case text; texts of ASCII and western letters need no other step
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
ODD = re.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ]")
# fixed values: the steps that are done here, as the tokenizer's file names them
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
DIVIDES = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# bytes that cannot be shown stand for themselves 256 places and more further on, in order
HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
SHOWN = {b: 256 + i for i, b in enumerate(HIDDEN)}


class Recent(dict):
    """What was met lately, in two generations: when the younger is full, the older is forgotten."""

    def __init__(self, made, most: int):
        super().__init__()
        self.made, self.most, self.old = made, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.made(key)
        if len(key) <= LONGEST:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class WordTokenizer:
    """Ids of whole texts from the ids of their parts.

    The tokenizer drops white space, lower-cases and divides a text into parts that its
    merge table takes one by one. A text of plain characters is divided here in the same
    way; any other goes through the whole tokenizer word by word. Lately met parts and
    words are kept, in bounded numbers. If a tokenizer's file names other steps than these,
    every text goes through it whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.parts = Recent(self._part, REMEMBERED)
        self.words = Recent(self._whole, REMEMBERED // 4)
        said = json.loads(self.tokenizer.to_str())
        self.known = (said.get("normalizer"), said.get("pre_tokenizer")) == (NORMALIZER, DIVIDES) and not said["model"].get("ignore_merges")

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        """``part``: lower-case letters, a digit, a run of signs or a short ending."""
        tokens = self.merges.tokenize(part if part.isascii() else part.encode().decode("latin-1").translate(SHOWN))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not self.known:
            return self._whole(text)
        if not ODD.search(text) and "<|" not in text:
            return b"".join(map(self.parts.__getitem__, PARTS.findall(text.lower())))
        if any(c in text for c in NOT_BLANK):
            return self._whole(text)
        return b"".join(map(self.words.__getitem__, text.split()))


@lru_cache(maxsize=1)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def lengths(n: int, longest: int = LENGTH) -> list[int]:
    """The pieces of n tokens: full sequences, then the binary digits of the rest, largest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def sequence_number(length: Column) -> Column:
    """Numbers that are unique, and in which all sequences of a length are one range."""
    bucket = F.length(F.conv(length.cast("string"), 10, 2)) - 1
    return bucket.cast("long") * F.lit(1 << 59) + F.monotonically_increasing_id()


def pack(documents: DataFrame, path: str, text: str = "text", key: str = "doc_id", longest: int = LENGTH) -> DataFrame:
    """One row a piece: key, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` are the piece's token ids, little-endian unsigned 32-bit; ``path`` is the
    tokenizer's file and ``longest`` a power of two. Each document is closed by one id
    more, so a null or empty text gives a single piece of one token. Repeated rows are
    packed each. Nothing is shuffled.
    """
    schema = documents.select(documents[key].alias("doc_id")).schema
    for name, kind in (("start", "long"), ("length", "long"), ("ids", "binary"), ("doc_tokens", "long")):
        schema = schema.add(name, kind)
    close = np.array([END], "<u4").tobytes()

    def batch_of(keys, rows):
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays(
            [keys.take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
             pa.array(columns[3], pa.binary()), pa.array(columns[4], pa.int64())],
            names=["doc_id", "start", "length", "ids", "doc_tokens"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode
        for batch in batches:
            keys, rows, waiting = batch.column("doc_id"), [], 0
            for i, value in enumerate(batch.column("text")):
                ids = encode(value.as_py() or "") + close
                n, start = len(ids) // 4, 0
                for size in lengths(n, longest):
                    rows.append((i, start, size, ids[4 * start : 4 * (start + size)], n))
                    start += size
                waiting += n
                if waiting >= FLUSH:
                    yield batch_of(keys, rows)
                    rows, waiting = [], 0
            yield batch_of(keys, rows)

    pieces = documents.select(documents[key].alias("doc_id"), documents[text].alias("text")).mapInArrow(run, schema)
    return pieces.select("*", sequence_number(F.col("length")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder a length."""
    pieces.write.partitionBy("length").parquet(path)
