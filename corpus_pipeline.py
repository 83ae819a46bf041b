"""From raw documents to packed training sequences, in five stages.

Each stage reads what its predecessor kept, applies one operator with its production
parameters to all of it, and returns the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.llm import decontam, ngram_join, packing, secrets, toxicity
from paperloom.llm.common import crc_mod, free_name, materialize, small_batches

TOXIC_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the cut. Null and empty texts score lowest and stay, rows without an id too; repeated rows share their fate, very long texts are read whole."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, crc_mod("doc_id", 4) != 2)
    score = free_name(docs, "__toxicity")
    return toxicity.score(docs, model, out=score).where(F.col(score) < TOXIC_FROM).select(*docs.columns)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id; of repeated rows one. Rows without an id stay."""
    small_batches(spark)
    return ngram_join.one_per_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its edit budget. Null and empty texts hold none; repeated rows share their fate, very long texts are searched whole."""
    small_batches(spark)
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in place of credentials, and ``n_chars`` of what is left. Null texts stay null and keep their ``n_chars``; repeated rows are redacted alike, very long texts whole."""
    small_batches(spark)
    clean = secrets.scan(docs, secrets.fit_formats(docs), redacted=True)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences. Null and empty texts are their end token; repeated rows are packed as often as they occur, very long texts cut and no token lost."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", one_per_group),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("packing", pack),
]

ORACLE_SQL = None  # models, edit distances and packing are beyond SQL; tests hold brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
