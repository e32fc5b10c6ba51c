"""From raw documents to token statistics: five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns the columns of ``documents``, but for the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from modlens.llm import decontaminate, secrets
from modlens.llm.common import saved, table
from modlens.llm.queries import KEEP_FROM, bpe_digests, graded


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return graded(spark, docs, sf_dir).where(F.col("tails")[1] >= KEEP_FROM).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; a document without words is no duplicate."""
    from modlens.llm import jaccard

    return jaccard.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage to speak of."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.is_contaminated()).select(docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; n_chars follows the text."""
    text = secrets.redacted(F.col("text"), F.col("__spans"))
    found = secrets.find_secrets(docs, out="__spans").withColumn("text", text)
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe_digests(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("secrets", secret_stage),
    ("tokens", token_stage),
]

#: A fitted classifier decides in the first stage: SQL cannot express that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each result written as Parquet and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
