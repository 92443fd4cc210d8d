"""Hints from tables of aligned exons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def introns(exons: DataFrame, threshold: float = 25, key=("prot", "gene"), order=("ordinal",), score: str = "exon_score") -> DataFrame:
    """Gaps between consecutive exons that both reach the threshold: key columns, start, end."""
    w = Window.partitionBy(*key).orderBy(*order)
    whole = exons.where(F.col("end") >= F.col("start"))
    before = whole.withColumns({"_end": F.lag("end").over(w), "_score": F.lag(score).over(w)})
    both = (F.col("_score") >= threshold) & (F.col(score) >= threshold)
    return before.where(both).select(*key, (F.col("_end") + 1).alias("start"), (F.col("start") - 1).alias("end"))


def terminal_codons(exons: DataFrame, regions: DataFrame, protein_lengths: DataFrame, threshold: float = 25) -> DataFrame:
    """Start and stop codons at the ends of each alignment: prot, gene, type, start, end.

    A start needs the protein's first residue, a score over the threshold and ATG; a stop fewer than five residues left and a stop
    codon behind the last exon. regions(gene, seq), protein_lengths(prot, length).
    """
    key = Window.partitionBy("prot", "gene")
    whole = exons.where(F.col("end") >= F.col("start")).withColumns({"up": F.row_number().over(key.orderBy("ordinal")), "down": F.row_number().over(key.orderBy(F.desc("ordinal")))})
    ends = whole.where((F.col("up") == 1) | (F.col("down") == 1)).where(F.col("exon_score") > threshold)
    # sequences come last, so that they are moved once, and both codons are looked for in one pass
    found = ends.join(protein_lengths.select("prot", F.col("length").alias("_n")), "prot").join(regions.select("gene", "seq"), "gene")
    codon = lambda at: F.substring(F.col("seq"), at.cast("int"), F.lit(3))
    at = lambda kind, start: F.struct(F.lit(kind).alias("type"), start.alias("start"), (start + 2).alias("end"))
    first = F.when((F.col("up") == 1) & (F.col("prot_start") == 1) & (codon(F.col("start")) == "ATG"), at("start_codon", F.col("start")))
    behind = F.col("end") + 1
    last = F.when((F.col("down") == 1) & (F.col("_n") - F.col("prot_end") < 5) & codon(behind).isin("TAA", "TAG", "TGA"), at("stop_codon", behind))
    return found.select("prot", "gene", F.explode(F.array_compact(F.array(first, last))).alias("codon")).select("prot", "gene", "codon.*")
