"""Corpus pipeline: quality rules, near duplicates, benchmark overlap, secrets, tokens.

``STAGES`` are (name, function) pairs; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written as Parquet and reread as the
next stage's ``docs``.  All but the last return the columns of ``documents``.

Defined results: extra columns are carried along untouched; null texts have no
words and are rejected by the quality rules; null ids are kept apart as the
operators state; an empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm import bpe, decontam, minhash_join, quality_rules, secret_scan
from emporium.llm.common import read, shared_dir, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    return quality_rules.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash_join.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with the benchmark."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark (``n_chars`` follows)."""
    out = secret_scan.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, decoded again as a check."""
    out = bpe.encode_and_decode(docs, tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    return out.select("doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("text_sha256"), "token_ids")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets),
          ("tokens", tokens)]

#: Token ids and redaction cannot be stated in SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is a table in the shared folder."""
    top = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{n}-{name}")
        docs = spark.read.parquet(f"{top}/{n}-{name}")
    return docs.select("doc_id", "n_tokens", "ids_sha256", "text_sha256")
