"""Exact duplicates by an exchange of compressed fingerprints.

Each chunk of documents sorts its fingerprints and sends every owner of a hash range its
share as a Golomb code. The owner answers with a bitmap of those that occur elsewhere too.
Only documents marked so, or met twice in their own chunk, are shuffled with their texts,
to be compared byte by byte.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlog.llm import rowstore
from shardlog.llm.common import squeezed, text_of
from shardlog.workdir import materialised

SLACK_BITS = 10  # a fingerprint has so many bits more than are needed to count the rows
OWNER_ROWS = 1_000_000  # fingerprints for one owner, about


def golomb(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted distinct numbers as gaps: the parameter's bits, quotients in unary, remainders."""
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = max(1.0, float(values[-1]) / len(values))
    low = max(0, int(math.log2(mean * math.log(2)))) if mean > 1.5 else 0
    ends = np.cumsum((gaps >> np.uint64(low)).astype(np.int64) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    places = np.arange(low, dtype=np.uint64)
    rest = ((gaps[:, None] >> places) & np.uint64(1)).astype(np.uint8)
    return low, np.packbits(unary).tobytes(), np.packbits(rest).tobytes()


def golomb_decoded(n: int, low: int, unary: bytes, rest: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(low)
    bits = np.unpackbits(np.frombuffer(rest, np.uint8), count=n * low).reshape(n, low)
    places = np.arange(low, dtype=np.uint64)
    gaps += (bits.astype(np.uint64) << places).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def _shares(fingerprints: pd.Series, bits: int, owners: int):
    """The chunk's distinct shortened fingerprints, how often each occurs, which of them each row has, where owners begin."""
    short = fingerprints.to_numpy().view(np.uint64) >> np.uint64(64 - bits)
    values, which, times = np.unique(short, return_inverse=True, return_counts=True)
    width = np.uint64(-(-(1 << bits) // owners))
    starts = np.searchsorted(values // width, np.arange(owners + 1, dtype=np.uint64))
    return values, times, which, starts, width


def suspects(store: DataFrame, rows: int) -> DataFrame:
    """One row a chunk, with 1 at each position whose fingerprint occurs more than once.

    ``store`` has ``chunk``, ``pos`` and ``fp``, a 64-bit hash. Shortened fingerprints can
    agree by chance, so a mark is a suspicion only; a document without one is unique.
    """
    conf = store.sparkSession.conf
    bits = min(63, max(1, math.ceil(math.log2(max(rows, 2)))) + SLACK_BITS)
    owners = max(int(conf.get("spark.sql.shuffle.partitions")), rows // OWNER_ROWS)
    narrow = store.select("chunk", "pos", "fp")

    def send(chunk: pd.DataFrame) -> pd.DataFrame:
        values, _, _, starts, width = _shares(chunk["fp"], bits, owners)
        sent = []
        for owner, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
            if b > a:
                sent.append((chunk["chunk"].iat[0], owner, b - a, *golomb(values[a:b] - np.uint64(owner) * width)))
        return pd.DataFrame(sent, columns=["chunk", "owner", "n", "low", "unary", "rest"])

    def answer(messages: pd.DataFrame) -> pd.DataFrame:
        read = [golomb_decoded(m.n, m.low, m.unary, m.rest) for m in messages.itertuples()]
        _, which, times = np.unique(np.concatenate(read), return_inverse=True, return_counts=True)
        twice = np.split(times[which] > 1, np.cumsum(messages["n"])[:-1])
        return pd.DataFrame({
            "chunk": messages["chunk"], "owner": messages["owner"], "twice": [np.packbits(t).tobytes() for t in twice],
        })

    def mark(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if chunk.empty:
            return pd.DataFrame({"chunk": [], "values": []})
        _, times, which, starts, _ = _shares(chunk["fp"], bits, owners)
        marked = times > 1
        for a in answers.itertuples():
            begin, end = starts[a.owner], starts[a.owner + 1]
            marked[begin:end] |= np.unpackbits(np.frombuffer(a.twice, np.uint8), count=end - begin).astype(bool)
        values = np.zeros(chunk["pos"].max() + 1, np.int8)
        values[chunk["pos"]] = marked[which]
        return pd.DataFrame({"chunk": chunk["chunk"].iloc[:1], "values": [values]})

    messages = narrow.groupBy("chunk").applyInPandas(
        send, "chunk long, owner int, n int, low int, unary binary, rest binary"
    )
    answers = messages.groupBy("owner").applyInPandas(answer, "chunk long, owner int, twice binary")
    return (
        narrow.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(mark, "chunk long, values array<tinyint>")
    )


class Duplicates:
    """Documents stored once, with the groups of equal texts among them.

    Texts are equal when identical after all white space is deleted; null is empty. Of a
    group, the row with the longest original text stays, then the one with the smallest
    id (null last); of rows equal in both, one of them. Empty tables give no rows.
    """

    def __init__(self, documents: DataFrame, text: str = "text", key: str = "doc_id"):
        self.key = key
        whole = text_of(documents[text])
        self.store = rowstore.stored(documents, "exact", fp=F.xxhash64(squeezed(whole)))
        self.text = text_of(F.col("row").getField(text))
        self.marks = materialised(suspects(self.store, self.store.count()), "suspects")
        self.marked = rowstore.with_value(self.store, self.marks, "suspect")
        self.groups = materialised(self._verified(), "copies")

    @property
    def digest(self) -> Column:
        return F.sha2(squeezed(self.text).cast("binary"), 256)

    @property
    def id(self) -> Column:
        return F.col("row").getField(self.key)

    def _verified(self) -> DataFrame:
        """Per text of the suspects: how many have it, and which row stays.

        The texts themselves are the grouping key, combined in each task before the
        shuffle, so a text that a third of all rows share is sent once by each task.
        """
        whole = (1 << 64) + 1
        length = F.length("whole").cast("decimal(38,0)")
        early = F.coalesce(F.lit((1 << 63) - 1).cast("decimal(38,0)") - F.col("id") + 1, F.lit(0).cast("decimal(38,0)"))
        rank = (length * F.lit(str(whole)).cast("decimal(21,0)") + early).cast("decimal(38,0)")
        rows = self.marked.where("suspect = 1").select(
            "chunk", "pos", self.id.alias("id"), self.text.alias("whole"), self.digest.alias("sha")
        )
        row = F.shiftleft("chunk", rowstore.POSITION_BITS).bitwiseOR(F.col("pos").cast("long"))
        return (
            rows.select("sha", squeezed(F.col("whole")).alias("norm"), "id", row.alias("number"), rank.alias("rank"))
            .groupBy("sha", "norm")
            .agg(
                F.count(F.lit(1)).alias("group_size"),
                F.max_by("id", "rank").alias("keep_id"),
                F.max_by("number", "rank").alias("keep_number"),
            )
            .drop("norm")
        )

    def report(self) -> DataFrame:
        """One row a document: its key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
        number = F.shiftleft("chunk", rowstore.POSITION_BITS).bitwiseOR(F.col("pos").cast("long"))
        rows = self.marked.select("suspect", self.id.alias(self.key), number.alias("number"), self.digest.alias("text_sha256"))
        alone = rows.where("suspect = 0").select(
            self.key, F.col(self.key).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
        )
        groups = self.groups.withColumnRenamed("sha", "text_sha256")
        grouped = (
            rows.where("suspect = 1")
            .join(groups, "text_sha256")
            .select(self.key, "keep_id", "group_size", (F.col("number") == F.col("keep_number")).alias("kept"), "text_sha256")
        )
        return alone.unionByName(grouped)

    def kept(self) -> DataFrame:
        """The documents that stay, with their own columns; no text is shuffled for it."""
        winners = self.groups.select(
            F.shiftright("keep_number", rowstore.POSITION_BITS).alias("chunk"),
            F.col("keep_number").bitwiseAND((1 << rowstore.POSITION_BITS) - 1).alias("pos"),
            F.lit(1).alias("value"),
        )
        stay = rowstore.with_value(self.marked, rowstore.by_chunk(winners), "winner")
        return rowstore.rows_of(stay.where("suspect = 0 or winner = 1"))
