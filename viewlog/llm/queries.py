"""The registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    bpe,
    collocations,
    jaccard_join,
    lattice_lm,
    line_rules,
    packing,
    prefix_bpe,
    quality,
    sharding,
    spelling,
    substring_dedup,
    topk,
    toxicity,
)
from .common import fold, read
from .oracle import oracle_sql

__all__ = ["oracle_sql", "registry"]

Query = Callable[[SparkSession, str], DataFrame]


def q_op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels outside fold 0."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id"), toxicity.FOLDS) == 0).alias("held_out"), "score", "predicted")


def q_op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its words in 20-word windows that start earlier elsewhere."""
    return substring_dedup.digests(read(spark, sf_dir, "documents"))


def q_op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the bytes they decode to."""
    return bpe.encode(read(spark, sf_dir, "documents"))


def q_op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of every document."""
    return line_rules.rule_verdicts(read(spark, sf_dir, "documents"))


def q_op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of nearly equal bytes."""
    return sharding.shard(read(spark, sf_dir, "documents"), scratch_path(spark, "slot-map"))


def q_op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict for every document, without given labels."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, *quality.fit(docs))


def q_op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under Jaccard links of 0.85 on 4-word shingles."""
    return jaccard_join.components(read(spark, sf_dir, "documents"))


def q_op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and lattice log probabilities of every text."""
    return lattice_lm.score(read(spark, sf_dir, "documents"))


def q_op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows of every query vector."""
    rows = topk.integer_vectors(read(spark, sf_dir, "embeddings"))
    return topk.top_k(rows, rows.where(F.col("vec_id") % topk.QUERY_EVERY == 0))


def q_op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into sequences of 2048 ids."""
    return packing.pack(read(spark, sf_dir, "documents"), with_ids=False)


def q_op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of every language."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


def q_op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every frequent word."""
    return spelling.variants(read(spark, sf_dir, "documents"))


def q_op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text under the word vocabulary, and the text they decode to."""
    return prefix_bpe.encode(read(spark, sf_dir, "documents"))


def registry() -> dict[str, Query]:
    return {
        "op1_toxicity": q_op1_toxicity,
        "op2_substring": q_op2_substring,
        "op3_bpe": q_op3_bpe,
        "op4_line_rules": q_op4_line_rules,
        "op5_sharding": q_op5_sharding,
        "op6_jaccard": q_op6_jaccard,
        "op7_quality": q_op7_quality,
        "op8_lattice_lm": q_op8_lattice_lm,
        "op9_topk": q_op9_topk,
        "op10_packing": q_op10_packing,
        "op11_collocations": q_op11_collocations,
        "op12_spelling": q_op12_spelling,
        "op13_prefix_bpe": q_op13_prefix_bpe,
    }
