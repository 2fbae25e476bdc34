"""Registered queries over the corpus operators, and their SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from shardlog.llm import (
    additive, bestfit, exact, hosts, language, licences, mixing, negatives, oracles, packing, pages, quality, quantise, simhash,
)
from shardlog.llm.common import table


# the shares of tokens that each domain of the labels table is to have
TARGETS = {"good": 0.90, "poor": 0.07, "toxic": 0.03}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = mixing.labelled(table(spark, sf_dir, "labels"))
    rows = mixing.mixture(table(spark, sf_dir, "documents"), labels, TARGETS)
    shares = (F.get("p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(TARGETS))
    return rows.select("doc_id", "tokens", *shares, "rate", "copies")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"), licences.known_digests(spark))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extracted(table(spark, sf_dir, "pages"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.Duplicates(table(spark, sf_dir, "documents")).report()


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcomes are the labels of the document that it shows, whose number stands in its path."""
    pages_ = table(spark, sf_dir, "pages")
    rows = hosts.judged(pages_, hosts.outcomes_of(pages_, table(spark, sf_dir, "labels")), RULES)
    return rows.select("page_id", "host", "path", "rule", "verdict")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    of_id = F.col("vec_id") % 7 == 0
    label = F.when(of_id, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = bestfit.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = quantise.compressed(table(spark, sf_dir, "embeddings"))
    hexed = F.lower(F.hex("code"))  # two digits a byte
    return rows.select("vec_id", hexed.alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


_ALL = (
    op1_mixing, op2_packing, op3_license_scan, op4_html_extraction, op5_exact_dedup, op6_simhash, op7_quality_rules,
    op8_url_filter, op9_language, op10_quality_classifier, op11_hard_negatives, op12_best_fit_packing,
    op13_vector_codes, pipeline,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {
    "op3_license_scan": oracles.license_scan(),
    "op5_exact_dedup": oracles.exact_dedup(),
    "op7_quality_rules": oracles.quality_rules(),
    "op8_url_filter": oracles.url_filter(RULES),
    "op11_hard_negatives": oracles.hard_negatives(),
    "op13_vector_codes": oracles.vector_codes(),
}
