"""The corpus pipeline: stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows its
predecessor kept.  All but the last return the columns of ``documents``;
where a stage changes ``text``, a column ``n_chars`` follows it.  Empty
tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mortar.llm.decontam import decontaminate
from mortar.llm.jaccard import keep_one
from mortar.llm.lines import dedup_lines
from mortar.llm.pieces import encode_texts
from mortar.llm.text import cut, small_batches
from mortar.llm.toxicity import keep_clean
from mortar.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents that the grammar scores as toxic."""
    return keep_clean(docs, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that many documents share; a document stays, if need be with an empty text."""
    done = dedup_lines(docs)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(
            F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents that hold a window of a benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids and their number."""
    ids = encode_texts(docs).drop("decoded")
    with small_batches(spark):
        return cut(ids.withColumn("n_tokens", F.when(F.col("ids") == "", 0).otherwise(
            F.length("ids") - F.length(F.replace("ids", F.lit(","))) + 1).cast("long")))


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("sentencepiece", encoding),
]

# Scoring, whole-set similarity and merging are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage's rows are written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
