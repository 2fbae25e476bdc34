"""A corpus made ready for training: judged, freed of copies, mixed and packed.

Each stage reads what its predecessor wrote. The last returns packed pieces, the others
documents with their own columns. Null texts count as empty; rows that are there twice are
rows of their own until exact dedup, and an empty table goes through every stage.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlog.llm import exact, mixing, packing, quality, simhash
from shardlog.llm.common import table
from shardlog.sources.files import remove
from shardlog.workdir import temporary, work_dir

# shares of tokens after mixing; where the rules leave nothing poor, its share stays unmet and the others keep theirs
TARGETS = {"good": 0.95, "poor": 0.03, "toxic": 0.02}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passing(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.Duplicates(docs).kept()


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words a shingle, and three fingerprints a document, so that more near copies come within reach."""
    return simhash.one_of_each(docs, shingle=5, families=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, mixing.labelled(table(spark, sf_dir, "labels")), TARGETS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix),
    ("packing", pack),
]

# SimHash, the classifier and the tokenizer have no counterpart in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces; what stages store in between goes as soon as the next one has written its rows."""
    docs, former = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = work_dir(spark, name.replace(" ", "-"))
        with temporary(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        if former is not None:
            remove(spark, former)
        docs, former = spark.read.schema(made.schema).parquet(path), path
    return docs
