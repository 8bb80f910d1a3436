"""A training corpus from raw documents: five stages, each one operator over all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm import common, decontaminate, lines, pieces, simhash, toxicity


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from four fifths of the labelled documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, ~toxicity.held_out(5, 0))
    return docs.filter(~toxicity.is_toxic(model))


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of ten or more different texts, ``n_chars`` brought up to date. Exact copies count once, else a text
    copied ten times would lose every line before the next stage could keep one of the copies."""
    kept = lines.drop_shared_lines(docs, count_copies=False).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: those whose SimHash fingerprints link, as op6 finds them, joined by those whose
    shingles are alike."""
    return simhash.without_near_copies(docs, radius=simhash.RADIUS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids, and whether decoding the ids gives the text back."""
    return pieces.encode(docs, round_trip="round_trip")


STAGES = [
    ("toxicity", toxic),
    ("line dedup", shared_lines),
    ("near-dedup", near_copies),
    ("decontamination", benchmark_leaks),
    ("pieces", piece_ids),
]

ORACLE_SQL = None  # models, fingerprints and pieces are not expressible; tests/llm holds each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = common.settle(stage(spark, docs, sf_dir))
    return docs
