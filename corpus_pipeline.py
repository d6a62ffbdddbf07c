"""Corpus pipeline: documents to packed training sequences.

Each stage works on all that the one before kept, and is written before the next
begins. Scratch tables of a stage are deleted when the next one starts, as its
result has then been written.

Defined results: rows that repeat a doc_id are one document and stay or go
together, unless they differ in what a stage judges; null texts are judged as
empty ones; other columns of ``documents`` pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog.llm import jaccard_join, packing, quality, substring_dedup, toxicity
from viewlog.llm.common import materialize, read, release

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model (trained on this stage's labelled input) accepts."""
    release()
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    release()
    scorer, _ = quality.fit(docs)
    return quality.accepted(docs, scorer)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by 5-word shingles at 0.8, the one with the least id."""
    release()
    found = jaccard_join.components(docs, words=5, percent=80)
    gone = found.where("component_id IS NOT NULL AND doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 20-word windows that start earlier elsewhere; ``n_chars`` follows the text."""
    release()
    cleaned = substring_dedup.dedup(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select([F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of fixed-length sequences, with their ids."""
    release()
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_copies", drop_near_copies),
    ("repeated_passages", drop_repeated_passages),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", held=True)
    return STAGES[-1][1](spark, docs, sf_dir)
