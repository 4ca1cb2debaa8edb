"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfall.llm import (
    compression, html_text, languages, merkle, passages, pieces, ranked_terms, search, simhash, site_lines, templates, token_files, toxicity,
)
from ledgerfall.llm.shared import fold, table

QUALITY_ACCEPTED = 0.7
TOXIC = 0.5


def quality_learnable() -> Column:
    return fold(F.col("doc_id"), 4) != 2


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) of which the document holds the item."""
    return templates.per_item(templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = compression.train(docs, table(spark, sf_dir, "labels"), quality_learnable())
    return compression.score(docs, model).select(
        "doc_id",
        (~quality_learnable()).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_ACCEPTED).cast("int").alias("predicted"),
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = site_lines.without_boilerplate(table(spark, sf_dir, "documents"), "source")
    return cleaned.select("doc_id", "text", "n_lines", "n_dropped")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extracted(pages, html_text.train(pages))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.written_and_read(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def toxicity_learnable() -> Column:
    return fold(F.col("doc_id"), 5) != 0


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity_learnable())
    return toxicity.score(docs, model).select(
        "doc_id",
        (~toxicity_learnable()).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )


def op9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each whole document whose id is divisible by 20."""
    docs = table(spark, sf_dir, "documents")
    queries = docs.where(F.col("doc_id") % 20 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return search.top_k(docs, queries)


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.without_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = fold(F.col("doc_id"), 5) == 0
    return merkle.document_proofs(table(spark, sf_dir, "documents"), tampered)


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for each benchmark item."""
    return ranked_terms.top_k(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = languages.train(docs, ~held_out)
    return languages.predicted(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_simhash": op4_simhash,
    "op5_line_dedup": op5_line_dedup,
    "op6_html_text": op6_html_text,
    "op7_token_files": op7_token_files,
    "op8_toxicity": op8_toxicity,
    "op9_search": op9_search,
    "op10_passages": op10_passages,
    "op11_manifest": op11_manifest,
    "op12_ranked": op12_ranked,
    "op13_language": op13_language,
}

ORACLE = {
    "op5_line_dedup": site_lines.ORACLE,
    "op11_manifest": merkle.ORACLE,
    "op12_ranked": ranked_terms.ORACLE,
}
