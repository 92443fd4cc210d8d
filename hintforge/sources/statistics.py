"""What a run knows about its genes, kept as bucketed tables for the next iteration.

Each table is bucketed and sorted by the column that the next iteration joins it on, so that those joins move the new side only: extents, pairs and
raw hints by gene, signatures by signature.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from hintforge.operators import genes

#: Buckets of a table: about one for each 100 MB of the largest.
BUCKETS = 64
JOINED_ON = {"extents": "gene", "pairs": "gene", "hints": "gene", "signatures": "signature"}


@dataclass(frozen=True)
class Statistics:
    """extents (see operators.genes), pairs(gene, prot, ordinal), raw hints, and signatures(gene, signature, first) of the longest isoforms."""

    extents: DataFrame
    pairs: DataFrame
    hints: DataFrame
    signatures: DataFrame


def save_statistics(seeds: DataFrame, pairs: DataFrame, hints: DataFrame, name: str, buckets: int = BUCKETS) -> None:
    """Writes the tables <name>_extents, <name>_pairs, <name>_hints and <name>_signatures of a run over seeds; earlier ones of that name go."""
    kept = genes.keep_longest(seeds)
    found = {"extents": genes.extents(kept), "pairs": pairs, "hints": hints, "signatures": genes.signatures(kept)}
    for what, df in found.items():
        key = JOINED_ON[what]
        df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(f"{name}_{what}")


def read_statistics(spark: SparkSession, name: str) -> Statistics:
    return Statistics(**{what: spark.table(f"{name}_{what}") for what in JOINED_ON})
