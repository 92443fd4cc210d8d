"""The thin driver-facing queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hintforge.llm import oracles
from hintforge.llm.centroid_clusters import cluster_vectors
from hintforge.llm.common import table
from hintforge.llm.decontaminate import contaminated
from hintforge.llm.divergence import source_divergence
from hintforge.llm.jaccard_join import jaccard_components
from hintforge.llm.lm_scoring import score_documents
from hintforge.llm.packing import pack_documents
from hintforge.llm.quality_rules import repetition_measures
from hintforge.llm.secret_scan import secret_spans
from hintforge.llm.substring_dedup import repeated_spans
from hintforge.llm.token_codes import encode_documents
from hintforge.llm.token_counts import count_tokens
from hintforge.llm.url_filter import judge_urls
from hintforge.llm.warc import archive_pages


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_measures(table(spark, sf_dir, "documents"))


def op2_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).drop("purity")


def op3_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, threshold=(90, 100))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each repeated span: which words of which document, and whether they go."""
    spans = repeated_spans(table(spark, sf_dir, "documents")).select("doc_id", F.explode("spans").alias("s"))
    return spans.select("doc_id", F.col("s.first").alias("first_word"), F.col("s.size").alias("n_words"), F.col("s.removed").alias("removed"), F.col("s.keeper").alias("keeper_doc_id"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), limit=4096)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1, capacity=4096)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_repetition_rules, op2_url_templates, op3_token_codes, op4_decontamination, op5_lm_scoring, op6_jaccard_join, op7_substring_dedup, op8_token_counts, op9_best_fit_packing, op10_warc, op11_source_divergence, op12_secret_scan, op13_centroid_clusters)}


def oracle_sql() -> dict[str, str]:
    return {"op1_repetition_rules": oracles.OP1, "op2_url_templates": oracles.OP2, "op4_decontamination": oracles.OP4, "op6_jaccard_join": oracles.OP6, "op10_warc": oracles.OP10, "op11_source_divergence": oracles.OP11, "op13_centroid_clusters": oracles.OP13}
