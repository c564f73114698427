"""The corpus pipeline: documents through five stages, each written and read again.

Each stage works on all rows that the one before it kept. Rows are dropped by the quality rules,
as exact copies, as near copies and by the mix; the last stage gives each text its pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veilframe.llm import exact_dedup, mixing, pieces, quality_rules, simhash
from veilframe.llm.common import table
from veilframe.llm.queries import MIX, PIECE_MODEL, QUERIES, SQL
from veilframe.session import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules or the cutoffs of their language and source reject go."""
    return quality_rules.quality_filter(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, white space aside, the longest and then first stays."""
    return exact_dedup.exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, the one with the smallest id stays."""
    return simhash.near_dedup(docs, shingle=4, radius=4)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn by probabilities that bring tokens to the target weights."""
    return mixing.mixed(docs, MIX)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with the ids of its pieces and their number, without its text."""
    model = pieces.read_model(PIECE_MODEL)
    return pieces.encoded(docs, model).drop("text")


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", near_stage),
    ("mixing", mixing_stage),
    ("pieces", pieces_stage),
]

# Fingerprints, the fit and the pieces are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name.replace(' ', '_')}")
    return docs


QUERIES = {**QUERIES, "pipeline": run}

__all__ = ["ORACLE_SQL", "QUERIES", "SQL", "STAGES", "run"]
