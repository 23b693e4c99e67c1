"""Registered queries of this package: one per operator, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.config import scratch_path
from fleetscope.llm import (alignment, jaccard_join, licenses, packing, periodic_runs, projections, quality, redirects, repetition,
                            schedule, surrogates, token_files, toxicity)
from fleetscope.llm.common import held_out, table
from fleetscope.llm.oracles import ORACLES  # noqa: F401

# The rules that op6 judges by: (verdict, host, path).
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents")).drop("key")


def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = repetition.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.drop("text")


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_texts(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op6_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = redirects.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.mix_report(table(spark, sf_dir, "documents")).drop("source")


def op8_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
                         "sequence_id", F.col("offset").cast("long").alias("offset"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, f"tokens-{uuid.uuid4().hex}")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder)
    return token_files.read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", periodic_runs.planted(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic_runs.run_digest(periodic_runs.periodic_runs(texts))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.alignment_report(table(spark, sf_dir, "documents"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_jaccard_join, op3_repetition, op4_surrogates, op5_quality, op6_redirects, op7_mix,
                                   op8_projections, op9_packing, op10_token_files, op11_periodic_runs,
                                   op12_alignment, op13_licenses)}
