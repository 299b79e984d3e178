"""A corpus pipeline in five stages, each a table of documents in and out. Part of the subpackage genefeat.llm.

Defined results: all stages take documents with the columns COLUMNS and return these alone, the last one topic and
probability besides; other columns of the input are left behind, whatever their names. A null text has no words, so the
rules reject it; a null language or source is "". Rows that repeat are near duplicates: one stays. Empty tables pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genefeat.functions.tables import drop_saved, save
from genefeat.llm import decontam, jaccard, mixing, rules, secrets
from genefeat.llm.common import hold, in_place
from genefeat.llm.queries import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their language's reference reject go."""
    return rules.quality_rules(docs, keep_columns=True).select(COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays (of rows that share it, one); documents
    without words are no group. What goes is listed and sent to the partition that holds it; texts stay where they are,
    and what is left of them is written within the setting that allows this."""
    held = hold(docs.select(COLUMNS))
    found = save(jaccard.held_components(held))
    ids = found.filter("doc_id <> component_id").select("doc_id").distinct()
    gone = found.join(ids, "doc_id", "left_semi").select("__part", "doc_id").distinct()
    with in_place(spark):
        left = save(held.join(gone.hint("shuffle_hash"), ["__part", "doc_id"], "left_anti").select(COLUMNS))
    drop_saved(held)
    twice = save(found.filter("doc_id is not null and doc_id = component_id").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if twice.isEmpty():
        return left
    several = left.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(twice, "doc_id", "left_anti").select(COLUMNS).unionByName(several.select(COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.without_contaminated(docs.select(COLUMNS), table(spark, sf_dir, "benchmark")).select(COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets are masked in the text unless they are spread widely, and n_chars follows."""
    masked = secrets.mask_live_secrets(docs.select(COLUMNS))
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast("bigint")).select(COLUMNS)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the target mix of sources, languages and topics, with their probability."""
    mixed = mixing.mix(docs.select(COLUMNS))
    return mixed.filter("kept").select(*COLUMNS, F.col("__topic").alias("topic"), F.round("probability", 6).alias("probability"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mixing_sources),
]

#: The divergence rules' references and the link components need more than one SQL text can say in reasonable time;
#: tests hold the stages against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = save(docs)
    return docs
