"""The registered queries of this subpackage and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, jaccard, licenses, lines, mixing, pst, resample, rules, runs, secrets, suffixes, trie
from .oracles import ORACLES  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source is the owner; its parts by language stand for the owner's repositories."""
    docs = table(spark, sf_dir, "documents").withColumn("repository", F.concat_ws("/", "source", "lang"))
    return secrets.secret_report(docs, repo_col="repository")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", F.col("__source").alias("source"), F.col("__lang").alias("lang"), F.col("__topic").alias("topic"), F.round("probability", 6).alias("probability"), "kept")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return resample.resample(table(spark, sf_dir, "documents"), good)


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).drop("class_id")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.duplicate_spans(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pst.score(table(spark, sf_dir, "documents"))


def op11_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("seed", F.crc32(F.col("doc_id").cast("string")))
    return runs.periodic_runs(docs, seed_col="seed")


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"), share=True)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scans,
        op2_benchmark_decontamination,
        op3_mixing,
        op4_quality_classifier,
        op5_chat_formatting,
        op6_license_scans,
        op7_ngram_jaccard_join,
        op8_suffix_array_dedup,
        op9_quality_rules,
        op10_lm_scoring,
        op11_periodic_run_detection,
        op12_conversation_prefix_trie,
        op13_line_dedup,
    )
}
