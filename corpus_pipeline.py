"""A training corpus from documents: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.llm import bpe, decontam, lines, minhash, quality
from changefold.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or that templates of their host make up, go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents share go; n_chars counts what is left."""
    kept = lines.dedup(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies stays."""
    gone = minhash.groups(docs).filter("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("gone_id"), "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and the bytes decoded from them, as digests."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                       public_tokenizers.PATTERN, keep=["doc_id"])


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("byte_bpe", encode),
]

#: The stages have no SQL form; tests hold them against a brute-force run.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each one's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
