"""The training-data pipeline over `documents`: from raw texts to packed sequences.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a DataFrame; run() writes it as Parquet and
rereads it as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hintforge.llm import decontaminate, jaccard_join, packing, quality_rules, substring_dedup
from hintforge.llm.common import stored, table
from hintforge.llm.queries import tokenizer_path

#: SQL can't express the banding, trees and packing; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by Jaccard 0.8 or more of 5-word shingles, the document with the smallest doc_id stays."""
    return jaccard_join.keep_one(docs, n=5, threshold=(8, 10))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller doc_id holds are cut out of the texts."""
    return substring_dedup.remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 or more of a benchmark item's 5-word shingles go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), short_items=True)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
