"""The queries of this subpackage, by name, and their SQL where SQL expresses them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.llm import quality
from chronolex.llm.common import fold, table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from chronolex.llm import bpe

    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.digests(table(spark, sf_dir, "documents"), tokens, public_tokenizers.PATTERN)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "clean_text", "lost_chars")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronolex.llm import langid

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold("doc_id") == 0).alias("held_out"))
    model = langid.train(docs.where("not held_out"))
    return langid.identify(docs.drop("lang"), model).drop("text")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronolex.llm import substrings

    return substrings.repeats(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronolex.llm import embeddings

    return embeddings.components(table(spark, sf_dir, "embeddings"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronolex.llm import simhash

    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronolex.llm import wrappers

    found = wrappers.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronolex.llm import classifier

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = classifier.train(docs, classifier.quality_labels(labels.where(fold("doc_id") != 0)))
    scored = classifier.score(docs.select("doc_id", "text", (fold("doc_id") == 0).alias("held_out")), weights)
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pathlib import Path

    import public_tokenizers

    from chronolex.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"), Path(public_tokenizers.path("word_bpe_49k.json")).read_text())


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronolex.llm import pii

    return pii.digests(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_quality_rules": op2_quality_rules,
    "op3_language_id": op3_language_id,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_simhash": op6_simhash,
    "op7_html_extraction": op7_html_extraction,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_packing": op9_packing,
    "op10_pii": op10_pii,
}
ORACLES: dict[str, str] = {"op2_quality_rules": quality.SQL}
