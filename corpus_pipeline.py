"""From raw documents to packed training sequences.

Each stage takes the documents its predecessor kept and applies one operator;
its decisions take effect. Stages that change texts bring n_chars up to date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import language_id, line_dedup, near_dedup, packing, secret_scan
from ledgerloom.llm.common import documents, stage


def measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    return language_id.recognised(docs, language_id.fit(*language_id.sample(docs.select("doc_id", "text", "lang"))))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines go, and documents of which nothing is left."""
    return measured(line_dedup.deduplicated(docs))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup.deduplicated(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced; every document stays."""
    return measured(secret_scan.redacted(docs, F.col("source")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return packing.best_fit(docs, packing.vocabulary())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", remove_near_duplicates),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

# Kernel scores, register sketches and token ids have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for number, (name, function) in enumerate(STAGES, 1):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
