"""Training corpus in five stages: quality, near copies, benchmark leaks, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns
of ``documents``; the last returns packed pieces. Results are written as Parquet between the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.llm import decontaminate, neardup, packing, pii, quality
from tabwright.llm.common import table
from tabwright.sources.scratch import written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose labelled neighbours vote for quality; the score is the classifier's own threshold."""
    opts = quality.KnnOptions()
    scored = quality.scored(docs, table(spark, sf_dir, "labels"), opts)
    return scored.where(F.col("quality_score") >= opts.threshold).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every near-duplicate group (five-word shingles, 0.8).

    Documents without words are in no group and stay, as do rows without an id; of rows that repeat an
    id one stays.
    """
    keep = neardup.near_duplicates(docs, neardup.MinHashOptions()).where("kept").select("doc_id").distinct()
    same_id = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    with_id = docs.where("doc_id IS NOT NULL").join(keep, "doc_id", "left_semi").withColumn("_r", F.row_number().over(same_id))
    return with_id.where("_r = 1").select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def unseen_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs)


def packs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in length buckets and token-budget batches."""
    return packing.packed(docs)


STAGES = [
    ("quality", good_quality), ("near_dedup", one_of_each), ("decontaminate", unseen_in_benchmark), ("pii", redacted),
    ("packing", packs),
]

#: Nearest-neighbour votes and belief propagation are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
