"""Registered queries of the text operators and their DuckDB twins.

Every query applies its operator, with production parameters, to the whole
table.  Digest columns are derived here; the operators return texts, spans
and arrays.  A twin exists where SQL can state the result over whole tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm import (bpe, chat_format, decontam, html_extract, license_scan, lm_score, minhash_join, periodic_runs,
                          quality_rules, secret_scan, suffix_dedup, token_align, token_counts)
from emporium.llm.common import read, shared_dir, tokenizer_path

RANKS = "byte_bpe_multi_50k.tiktoken"
COUNTED = "byte_bpe_50k.json"
ALIGNED = "piece_bpe_32k.model"
#: Tokens of a training sequence.
LIMIT = 512


def _joined(spans: str, *fields: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", *[s[f].cast("string") for f in fields])), ",")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number and list of benchmark items."""
    docs = read(spark, sf_dir, "documents")
    bad = decontam.contaminated(docs, read(spark, sf_dir, "benchmark"))
    rows = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("_row"))
    bad = bad.select(F.col("doc_id").alias("_d"), F.col("_row").alias("_r"), "n_items", "items")
    out = rows.join(bad, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_row") == F.col("_r")), "left")
    return out.select("doc_id", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("items", F.lit("")).alias("items"), F.col("n_items").isNotNull().alias("contaminated"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_and_decode(read(spark, sf_dir, "documents"), tokenizer_path(RANKS))
    return out.select("doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a repeated passage: word spans, and those to cut."""
    out = suffix_dedup.repeated_passages(read(spark, sf_dir, "documents"))
    size = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", F.size("repeated").cast("long").alias("n_spans"), size("repeated").alias("n_repeated_words"),
                      size("cut").alias("n_cut_words"), _joined("repeated", "start", "end").alias("spans"),
                      _joined("cut", "start", "end").alias("cut_spans"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(read(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(read(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.BASE]
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.withColumn("_base", F.filter("spans", lambda s: s["kind"].isin(base))).select(
        "doc_id", *[n(k) for k in base], F.sha2(_joined("_base", "kind", "start", "end"), 256).alias("base_sha256"),
        _joined("spans", "kind", "start", "end").alias("spans"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                      F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
                      F.array_join("base_list", ",").alias("base_labels"), F.array_join("label_list", ",").alias("labels"),
                      "score")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat_format.perspectives(read(spark, sf_dir, "conversations"))
    return out.select("conv_id", "speaker", "part", "n_turns", "rendered", "start", _joined("masks", "start", "end").alias("masks"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      F.array_join("failed_rules", ",").alias("failed_rules"), "n_stop_words")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm_score.score(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_backoff", F.round(F.col("log_score") / F.col("n_words"), 6).alias("mean_log_score"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(read(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_align.align(read(spark, sf_dir, "documents"), tokenizer_path(COUNTED), tokenizer_path(ALIGNED))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                      F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so every run does the whole work."""
    cache = f"{shared_dir(spark)}/token-counts-{uuid.uuid4().hex}"
    out = token_counts.token_counts(read(spark, sf_dir, "documents"), cache, tokenizer_path(COUNTED))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.periodic_runs(periodic_runs.with_tails(read(spark, sf_dir, "documents")))
    line = lambda s: F.concat(F.concat_ws(",", *[s[f].cast("string") for f in ("start", "length", "period")]), F.lit("\n"))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_byte_bpe, op3_suffix_dedup, op4_minhash_dedup, op5_secret_scan, op6_license_scan,
    op7_chat_format, op8_quality_rules, op9_lm_score, op10_html_extract, op11_token_align, op12_token_counts,
    op13_periodic_runs)}

from emporium.llm.twins import SQL as ORACLE  # noqa: E402

