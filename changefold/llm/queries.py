"""One query for each operator, over its whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.llm import (
    bpe, decontam, divergence, filter_audit, licenses, lines, minhash, quality, secret_scan, substrings, toxicity,
    url_filter, warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                       tokenizers.PATTERN, keep=["doc_id"])


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"),
        "score", F.size("detections").cast("long").alias("n_detections"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, (n_words, _, sizes, items, _) = decontam.scan(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, n: a + n)
    return found.select(
        "doc_id", F.col(n_words).alias("n_words"), n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        sha256(F.array_join(F.array_sort(items), ",")).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(table(spark, sf_dir, "documents"), keep=["doc_id", "text"])
    return found.select("doc_id", "n_words", "n_removed", sha256(F.col("text")).alias("kept_sha256"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(docs).select("doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers
    found = secret_scan.scan(
        table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        tokenizers.PATTERN, keep=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id", *[secret_scan.count(F.col("spans"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        sha256(secret_scan.told(base)).alias("base_sha256"), secret_scan.told(F.col("spans")).alias("spans"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of a page is the quality of the document with its id, where it has a label."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return url_filter.judge(table(spark, sf_dir, "pages"), outcomes).select("page_id", "host", "path", "rule", "verdict")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_byte_bpe, op2_license_scan, op3_decontamination, op4_toxicity, op5_substring_dedup, op6_minhash, op7_line_dedup,
        op8_secret_scan, op9_warc, op10_quality_rules, op11_source_divergence, op12_filter_audit, op13_url_filter,
        pipeline)
}
