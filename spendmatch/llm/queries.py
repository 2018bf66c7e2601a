"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    decontam, divergence, infill, katz, lines, packing, paragraphs, pii, rans, secrets, simhash, toxicity, vector_graph)
from ._work import read


def op1_katz_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return katz.score(docs, held=F.crc32(F.col("doc_id").cast("string")) % 7 == 2, order=2)


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_rans_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.report(decontam.scan(docs, read(spark, sf_dir, "benchmark"), n=10))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeats(read(spark, sf_dir, "documents"), threshold=0.8)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.93)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, read(spark, sf_dir, "labels"), cutoff=0.3).select("doc_id", "held_out", "score", "predicted")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=2)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.scan(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op11_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"), min_docs=3, top=200)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.report(infill.transform(read(spark, sf_dir, "documents").select("doc_id", "text"), seed=7, rate=100, spm_rate=50))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(lines.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=10))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_katz_lm_scoring, op2_secret_scans, op3_rans_token_output, op4_benchmark_decontamination, op5_best_fit_packing,
        op6_substring_dedup, op7_embedding_near_dedup, op8_toxicity, op9_simhash_near_dedup, op10_pii, op11_source_divergence_audit,
        op12_fill_in_middle, op13_line_dedup)
}
