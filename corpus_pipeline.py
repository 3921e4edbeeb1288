"""The corpus pipeline: quality rules, near-duplicates, secrets, mixing, pieces.

Every stage works on all that the one before kept, and returns the columns of ``documents``; the
last returns the encoded documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import mixing, neardup, pieces, quality, secretscan
from lakeloom.llm.common import Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return _columns(quality.kept_rows(_columns(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (a similarity of 0.8 or more) stays."""
    return _columns(neardup.keep_one(_columns(docs), num=80, den=100))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    return _columns(secretscan.redact(_columns(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources get equal shares of the characters; documents are repeated or left out accordingly."""
    return _columns(mixing.mix(_columns(docs)))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents as piece ids."""
    return pieces.encode(_columns(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("mix sources", mix_sources),
    ("pieces", encode_pieces),
]

#: The lattice and the similarity verification have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = _columns(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    scratch = Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.save(docs, f"stage{k}")
    return docs
