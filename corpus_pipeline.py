"""The corpus pipeline: documents in, clean texts and the counts of a mix out, one table per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelkit.llm import decontaminate, jaccard, mixing, quality, secrets
from modelkit.llm.common import read
from modelkit.session import scratch_dir

# Near duplicates by shingles of five words at a similarity of 0.8 or more.
NEAR = jaccard.Rule(size=5, above=8, below=10)
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. The trees are fitted on the labelled documents among these."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join: the one with the smallest doc_id, and rows repeated whole once."""
    joined = jaccard.join_groups(docs, NEAR).select(F.col("doc_id").alias("kept_id"), "component_id")
    kept = joined.where(F.col("kept_id") == F.col("component_id")).select("kept_id").distinct()
    rows = docs.join(kept, docs["doc_id"] == kept["kept_id"], "left_semi").dropDuplicates(["doc_id"])
    return rows.unionByName(docs.where("doc_id is null")).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text no benchmark item is tiled in. Equal texts are judged alike."""
    marked = docs.withColumn("text_md5", F.md5("text"))
    leaked = decontaminate.leaks(marked, read(spark, sf_dir, "benchmark"), keys=("text_md5",)).select("text_md5").distinct()
    return marked.join(leaked, "text_md5", "left_anti").select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found replaced by a mark."""
    scanned = secrets.scan(docs)
    clean = secrets.redacted(F.col("text"), F.col("findings"))
    return scanned.withColumn("text", clean).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mixed(docs).taken()


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
]
# The trees, the removal of near duplicates and the drawn mix are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's table is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
