"""The contract queries: each operator over its whole table, with the digest columns derived from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import alignment, bpe, chat, fingerprints, licenses, mtree, neardup, oracle, packing, pages, quality, repeats, resampling, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_rules(docs, _table(spark, sf_dir, "labels")).drop("text")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(toxicity.remainder("doc_id") == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op4_chat_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chats(_table(spark, sf_dir, "conversations"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pages.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(_table(spark, sf_dir, "documents"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return mtree.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op10_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents")))
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_license_scan, op2_quality_rules, op3_toxicity, op4_chat_transcripts, op5_minhash_near_dedup, op6_packing, op7_html_extraction, op8_suffix_dedup, op9_exact_topk, op10_bpe_roundtrip, op11_target_resampling, op12_cross_tokenizer_alignment, op13_document_fingerprints)}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
