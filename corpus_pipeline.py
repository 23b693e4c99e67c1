"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns a DataFrame; ``run`` writes each result as Parquet in the
shared folder and reads it back as the next stage's input. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.config import scratch_path
from fleetscope.llm.common import staged
from fleetscope.llm.jaccard_join import jaccard_join
from fleetscope.llm.packing import pack_documents
from fleetscope.llm.repetition import quality_rules
from fleetscope.llm.schedule import mixed_documents
from fleetscope.llm.surrogates import replace_entities
from fleetscope.plans.stage import staging

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return quality_rules(docs.select(*COLUMNS)).filter("kept").select(*COLUMNS)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, whatever the ids: the one
    with the smallest id (rows without an id come last), then by the other
    columns. Rows of one id whose texts are not near each other all stay; of
    the rows whose texts have no words, one stays for each id."""
    # A row's number stands for its id, so every row is judged by its own text.
    rows = staged(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    judged = jaccard_join(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id")
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("x"), F.xxhash64(F.lit(7), "text").alias("y"),
                    "lang", "source", "n_chars", "row")
    ranked = rows.select("row", wordless.alias("wordless"), rank.alias("rank")).join(judged, "row")
    ranked = staged(ranked.withColumn("component", F.when(F.col("wordless"), F.col("rank.doc_id")).otherwise(F.col("component_id"))), "ranked")
    first = ranked.groupBy("wordless", "component").agg(F.min("rank").alias("rank")).select("rank.row")
    gone = ranked.select("row").join(first, "row", "left_anti")
    return rows.join(gone, "row", "left_anti").select(*COLUMNS)


def hide_entities(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates; ``n_chars`` follows changed texts."""
    done = replace_entities(docs.select(*COLUMNS))
    return done.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids, sequence and place."""
    return pack_documents(docs)


STAGES = [("quality_rules", keep_by_quality), ("ngram_jaccard_join", keep_one_of_group), ("pii_surrogates", hide_entities),
          ("mix_sources", mix_sources), ("best_fit_packing", pack_sequences)]

# Tokenising cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of the folder. Each stage's own staged
    tables go when its output is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        with staging(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
