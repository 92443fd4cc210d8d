"""Benchmark decontamination by size-partitioned MinHash containment search (operator 4). DataFrame functions only.

Test items are partitioned by size (powers of two of their distinct 5-word shingles; an item of fewer words has its whole sequence as
its one shingle). An item's sketch is its bottom-k MinHash, on the item's side alone: the k shingles with the smallest hashes. In a partition whose items have up to n shingles, k = floor((1 - threshold) * n) + 1:
a document that holds `threshold` of an item lacks fewer than k of its shingles, so at least one of the sketch is there and no true
match is missed, however long the document (the sketch is a prefix filter in MinHash order). Candidates are verified by exact containment of shingles, compared as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hintforge.llm.common import stored

#: Sketch or item rows, and suspect documents, up to which they are broadcast; beyond it the joins shuffle.
BROADCAST_ROWS, BROADCAST_SUSPECTS = 500_000, 4_000_000


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_rows(df: DataFrame, text: str, n: int) -> DataFrame:
    """df's other columns with one row for each window of n words: its words as w0..w(n-1)."""
    keep = [c for c in df.columns if c != text]
    words = df.select(*keep, words_of(F.col(text)).alias("_w")).where(F.size("_w") >= n)
    size = F.size("_w") - (n - 1)
    zipped = F.arrays_zip(*(F.slice("_w", F.lit(k + 1), size).alias(f"w{k}") for k in range(n)))
    return words.select(*keep, F.inline(zipped).alias(*(f"w{k}" for k in range(n))))


def shingle_texts(df: DataFrame, n: int, fewer: list[int]) -> DataFrame:
    """df's columns but text, with shingle: each window of n words, and of each of the numbers in fewer."""
    out = None
    for k in [n, *fewer]:
        rows = shingle_rows(df, "text", k).select(*(c for c in df.columns if c != "text"), F.concat_ws(" ", *(f"w{j}" for j in range(k))).alias("shingle"))
        out = rows if out is None else out.unionByName(rows)
    return out


def contaminated(docs: DataFrame, items: DataFrame, n: int = 5, threshold: float = 0.8, short_items: bool = False) -> DataFrame:
    """doc_id, item_id, n_shingles, n_found for every pair in which the document holds at least `threshold` of the item's shingles.

    docs(doc_id, text, ...), items(item_id, text, ...); other columns are not read. A null text has no shingle; an item of fewer
    than n words is found by its whole sequence of words with short_items, and nowhere without. Rows with one doc_id count as one document, rows with one item_id as one
    item; null ids are ids of their own. Pairs are distinct; empty tables give an empty one.
    """
    texts, asked = docs.select("doc_id", "text"), items.select("item_id", "text")
    fewer: list[int] = []
    parts = shingle_texts(asked, n, [])
    if short_items:
        short = asked.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w").between(1, n - 1))
        fewer = sorted(r.k for r in short.select(F.size("w").alias("k")).distinct().collect())  # n - 1 rows at most
        parts = parts.unionByName(short.select("item_id", F.array_join("w", " ").alias("shingle")))
    parts = parts.distinct().withColumn("h", F.xxhash64("shingle"))
    sizes = parts.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    upper = F.pow(F.lit(2.0), F.ceil(F.log2("n_shingles")))
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy("h", "shingle")))
    # 1e-9: the share of a threshold like 0.8 is not exact in binary
    sketch = ranked.join(sizes, ranked["item_id"].eqNullSafe(sizes["item_id"])).where(F.col("rank") <= F.floor((1 - threshold) * upper + 1e-9) + 1).select("h").distinct()
    small = parts.count() <= BROADCAST_ROWS
    near = F.broadcast if small else (lambda df: df)
    hashed = shingle_texts(texts, n, fewer).select("doc_id", F.xxhash64("shingle").alias("h"))
    suspects = stored(hashed.join(near(sketch), "h", "left_semi").select("doc_id").distinct().withColumnRenamed("doc_id", "suspect"), "suspects")
    few = F.broadcast(suspects) if suspects.count() <= BROADCAST_SUSPECTS else suspects
    again = texts.join(few, texts["doc_id"].eqNullSafe(suspects["suspect"]), "left_semi")
    found = shingle_texts(again, n, fewer).withColumn("h", F.xxhash64("shingle"))
    hits = found.join(near(parts), ["h", "shingle"]).select("doc_id", "item_id", "shingle").distinct().groupBy("doc_id", "item_id").agg(F.count("*").alias("n_found"))
    named = sizes.withColumnRenamed("item_id", "_item")
    return hits.join(near(named), F.col("item_id").eqNullSafe(F.col("_item"))).where(F.col("n_found") >= threshold * F.col("n_shingles") - 1e-9).select("doc_id", "item_id", "n_shingles", "n_found")


def drop_contaminated(docs: DataFrame, items: DataFrame, n: int = 5, threshold: float = 0.8, short_items: bool = False) -> DataFrame:
    """The rows of docs whose document holds no item. A row without doc_id is a document of its own, known by its text."""
    name = F.struct("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).alias("copy"))
    found = contaminated(docs.select(name.alias("doc_id"), "text"), items, n, threshold, short_items).select(F.col("doc_id.doc_id").alias("_found"), F.col("doc_id.copy").alias("_copy")).distinct()
    copy = F.when(docs["doc_id"].isNull(), F.xxhash64(docs["text"]))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_found"]) & copy.eqNullSafe(found["_copy"]), "left_anti")
