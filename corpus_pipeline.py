"""The corpus pipeline: quality classifier, near-dedup, substring dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and calls one operator of ``lineweave.llm`` on all that the stage
before kept. The first four return the columns of their input; the last returns packed pieces. What the
operators say about nulls, empty texts, ties, repeated rows, empty tables and other columns holds for
the stages too; two points are the stages' own: a document that substring dedup leaves without a word
is dropped (untouched ones never are), and ``n_chars``, where it is a column, follows the new text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweave.llm.decontaminate import remove_contaminated
from lineweave.llm.near_dedup import keep_one_of_each
from lineweave.llm.packing import packed_pieces
from lineweave.llm.quality import keep_quality
from lineweave.llm.substring_dedup import remove_repeated_passages
from lineweave.llm.tables import cut, read_table
from lineweave.llm.touched import fresh_name


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_quality(docs, docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return keep_one_of_each(docs, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document holds are cut out."""
    ranges = fresh_name(docs, "_ranges")
    out = remove_repeated_passages(docs, ranges=ranges)
    touched = F.size(ranges) > 0
    if "n_chars" in docs.columns:
        n_chars = F.when(touched, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return out.where(~touched | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece of a document."""
    return packed_pieces(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The classifier, sketches and chunks are no SQL; tests/llm/test_pipeline.py holds brute force against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
