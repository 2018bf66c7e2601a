"""Corpus preparation: ``documents`` through STAGES, each stage on what the one before it kept.

A stage is (name, function); the function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet and rereads as the next
stage's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendmatch.llm import decontam, packing, secrets, simhash, toxicity
from spendmatch.llm._work import Work, read

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.score(docs, read(spark, sf_dir, "labels")).where("predicted = 0").select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, that with the smallest id; a row without an id stays.

    The decision falls on rows, by a written row key, so rows that share an id go or stay by their own text.
    """
    work = Work(spark, "simhash_rows")
    rows = work.table(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    named = rows.where("doc_id is not null")
    found = simhash.near_duplicates(named, shingle=3, radius=2, id_col="__row").select(F.col("doc_id").alias("__row"), "component_id")
    first = found.join(named.select("__row", "doc_id"), "__row").groupBy("component_id").agg(
        F.min(F.struct("doc_id", "__row"))["__row"].alias("__row"))
    return rows.join(first.select("__row"), "__row", "left_semi").unionByName(rows.where("doc_id is null")).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document of nothing else goes."""
    found = decontam.scan(docs, read(spark, sf_dir, "benchmark"), n=10, remove=True)
    return _sized(found.where((F.size("hit_words") == 0) | (F.size("hit_words") < F.col("n_words")))).select(*docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return _sized(secrets.redact(docs)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left becomes training sequences, one row per piece."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scans", secrets_stage),
    ("best_fit_packing", packing_stage),
]
ORACLE_SQL = None  # learned scores and tokenizer ids have no SQL form; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``."""
    docs, work = read(spark, sf_dir, "documents"), Work(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = work.table(stage(spark, docs, sf_dir), name)
        if k:
            work.drop(STAGES[k - 1][0])
    return docs
