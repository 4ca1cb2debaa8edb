"""A corpus pipeline: five operators in a row, each on all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame; it is written as
Parquet to the shared folder and reread as the next stage's ``docs``.

All stages work on whole texts of any length, return no rows for no rows, and keep
any further columns of ``docs`` but the last, which returns ids.  Null texts count as
empty where a stage reads them, and stay null; rows without ``doc_id`` are documents like
others; of rows that repeat an id and text, each has the same decision, until near
duplicates leave one of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfall.llm import compression, pieces, shared, simhash, site_lines, templates
from ledgerfall.llm.queries import QUALITY_ACCEPTED, quality_learnable


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is accepted; null and empty texts have the score of no evidence."""
    model = compression.train(docs, shared.table(spark, sf_dir, "labels"), quality_learnable())
    return compression.score(docs, model).where(F.col("score") >= QUALITY_ACCEPTED).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; ``n_chars`` follows the text, null for a null one.

    Null sources are one site; repeated rows are pages each.
    """
    cleaned = site_lines.without_boilerplate(docs, "source")
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, that with the least id; empty texts are alike, rows without id stay."""
    return simhash.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts and items hold nothing."""
    return templates.without_contaminated(docs, shared.table(spark, sf_dir, "benchmark"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each remaining document, with parity and round trip; null and empty texts have none."""
    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: Compressed sizes, fingerprints and merges are not SQL; tests compare with a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = shared.stored(stage(spark, docs, sf_dir))
    return docs
