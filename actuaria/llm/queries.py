"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actuaria.llm import (
    best_fit, conversations, embedding_dedup, licenses, line_dedup, mixing, ngram_join, packing, quality, secrets, spelling, substring_dedup, toxicity,
)
from actuaria.llm.common import Workspace, table
from actuaria.llm.oracle import ORACLES


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), Workspace(spark, "op1"))
    return done.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("__kept", 256).alias("kept_sha256")
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), Workspace(spark, "op3"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), Workspace(spark, "op5"), size=4, percent=85)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), Workspace(spark, "op6"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.train(docs, labels, Workspace(spark, "op7")))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = substring_dedup.repeated_spans(table(spark, sf_dir, "documents"), Workspace(spark, "op8"))
    return spans.select("doc_id", "start", "end", "n_units", "n_words", "kept_doc_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), Workspace(spark, "op9"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_broken"
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), Workspace(spark, "op11"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return best_fit.pack_best_fit(docs, public_tokenizers.path("word_bpe_49k.json"), Workspace(spark, "op12"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "op13")
    original = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = conversations.damage(original)
    repaired = work.write(conversations.repair(rows, work), "repaired")
    hashed = conversations.digests(rows, repaired).withColumnRenamed("conv_id", "h_conv")
    told = repaired.join(hashed, F.col("conv_id").eqNullSafe(F.col("h_conv"))).withColumnRenamed("conv_id", "r_conv")
    every = original.select("conv_id").distinct().join(told, F.col("conv_id").eqNullSafe(F.col("r_conv")), "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return every.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), digest)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [f for name, f in globals().items() if name.startswith("op") and callable(f)]
    return {f.__name__: f for f in sorted(found, key=lambda f: int(f.__name__[2:].split("_")[0]))}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
