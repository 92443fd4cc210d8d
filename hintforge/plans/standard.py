"""Whole runs: raw hints to results, and the next iteration after seeds changed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hintforge.config import QUALITY, Cutoffs, EngineConfig
from hintforge.operators import genes, hints, search
from hintforge.sources import features, sequences
from hintforge.storage import stored, written


@dataclass(frozen=True)
class Results:
    combined: DataFrame
    evidence: DataFrame
    chains: DataFrame
    export: DataFrame


def combined_hints(raw: DataFrame, quality: Cutoffs = QUALITY, strict_support: bool = False) -> DataFrame:
    """Introns, stops and starts combined, starts with cds_overlap of supported coding segments.

    raw is read once: all types are cut and combined in one pass, which is persisted (memory, then disk) for the four looks at it.
    """
    every = hints.combine(hints.filter_hints(raw, quality)).persist(StorageLevel.MEMORY_AND_DISK)
    of = lambda *kinds: every.where(F.col("type").isin(*kinds))
    cds = hints.supported_cds(of("CDS"), of("Intron", "start_codon"), strict_support)
    counted = hints.count_overlaps_binned(of("start_codon"), cds)
    return of("Intron", "stop_codon").unionByName(counted, allowMissingColumns=True)


def exported(combined: DataFrame, evidence: DataFrame, chained: DataFrame) -> DataFrame:
    """Three sources for a gene finder in one table: P classified hints, M manual-like high-confidence ones, C chains by group.

    Each keeps its phase (`.` if the table has none) and its source's name; al_text is the score as it was written, if known.
    """
    kind = F.when(F.col("type") == "Intron", "intron").when(F.col("type") == "start_codon", "start").when(F.col("type") == "stop_codon", "stop").otherwise(F.col("type"))

    def part(df: DataFrame, src: str, **own: Column) -> DataFrame:
        text = lambda name: F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")
        none = {"mult": F.lit(1).cast("long"), "class": F.lit(None).cast("int"), "al_score": F.lit(None).cast("double"), "al_text": F.lit(None).cast("string"), "grp": F.lit(None).cast("string")} | own
        return df.select("seqid", text("source").alias("source"), kind.alias("type"), "start", "end", "strand", F.coalesce(text("phase"), F.lit(".")).alias("phase"), F.lit(src).alias("src"), *(c.alias(n) for n, c in none.items()))

    mult = F.col("score").cast("long")
    classified = hints.classify(combined)
    al_text = F.col("al_text") if "al_text" in combined.columns else F.lit(None).cast("string")
    p = part(classified, "P", **{"mult": mult, "class": F.col("class").cast("int"), "al_score": F.col("al_score"), "al_text": al_text})
    c = part(chained, "C", grp=F.concat_ws("_", "prot", "gene"))
    return p.unionByName(part(evidence, "M", mult=mult)).unionByName(c)


def export_lines(export: DataFrame, priority: int = 4, source: str = "protein_hint") -> DataFrame:
    """The export as lines of nine columns; attributes as the three sources have them. source names rows that have none of their own."""
    pri = F.lit(f"pri={priority}")
    al = F.coalesce("al_text", F.col("al_score").cast("string"), F.lit(""))
    attrs = (
        F.when(F.col("src") == "P", F.concat(F.lit("src=P;mult="), "mult", F.lit(";"), pri, F.lit(";al_score="), al, F.lit(";")))
        .when(F.col("src") == "M", F.concat(F.lit("src=M;mult="), "mult", F.lit(";"), pri))
        .otherwise(F.concat(F.lit("grp="), "grp", F.lit(";src=C;"), pri, F.lit(";")))
    )
    score = F.coalesce(F.col("class"), F.when(F.col("src") == "M", F.col("mult")).otherwise(1)).cast("string")
    return export.select(F.concat_ws("\t", "seqid", F.coalesce("source", F.lit(source)), "type", "start", "end", score, "strand", "phase", attrs).alias("value"))


def standard_run(raw: DataFrame, pairs: DataFrame, config: EngineConfig = EngineConfig()) -> Results:
    """From lifted raw hints (gene, prot known) and ranked pairs to all results. raw is read once.

    Inputs are checked as hints meet their pairs; faults are those of check_inputs.
    """
    # stored: hints meet their pairs once, for the checks and for all results
    known = stored(hints.known_top(raw, pairs), "flagged")
    facts = known.agg(F.count("*").alias("n"), F.count("top").alias("known"), F.count_if("top").alias("top")).first()
    if facts["known"] < facts["n"] or not facts["top"]:
        check_inputs(pairs, known.drop("top"))
    flagged = known.where("top IS NOT NULL")
    combined = combined_hints(flagged, config.quality, config.strict_support)
    evidence = hints.filter_hints(combined, config.cutoffs)
    chained = hints.chains(flagged.where("top"), config.chain_cut, config.quality)
    return Results(combined, evidence, chained, exported(combined, evidence, chained))


def lifted_hints(seeds: DataFrame, genome: DataFrame, proteins: DataFrame, aligner: Callable[[pd.DataFrame], pd.DataFrame], config: EngineConfig = EngineConfig(), pairs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(raw hints on the genome, pairs): seeds' longest isoforms are translated and searched for among the proteins, unless pairs are given; the
    best proteins of each are aligned with the window around the gene, and what the aligner finds there is lifted to the genome.

    seeds as features.read_genes gives them; proteins have id and seq, genome too, or it comes in pieces.
    """
    kept = written(genes.keep_longest(seeds))
    if pairs is None:
        coding = written(genes.coding_sequences(kept, genome).where(F.length("protein") >= config.min_seed_protein))
        scoring = search.Scoring.from_file(genome.sparkSession, config.matrix) if config.matrix else search.Scoring()
        pairs = search.scored_pairs(coding.select(F.col("gene").alias("id"), F.col("protein").alias("seq")), proteins, config.word, config.max_proteins_per_seed, config.e_value, scoring)
    else:  # those of genes that are worked on: ordinals of others may be of another list
        pairs = pairs.join(kept.select("gene").distinct(), "gene", "left_semi")
    pairs = written(hints.top_k_targets(pairs, config.max_proteins_per_seed).drop("rank"))
    lengths = sequences.piece_lengths(genome) if "chunk" in genome.columns else genome.select(F.col("id").alias("seqid"), F.length("seq").cast("long").alias("length"))
    regions = written(genes.windows(genes.extents(kept), lengths, config.window, config.max_gene))
    cut = written(genes.region_sequences(regions, pairs, genome))
    # written: a lost executor doesn't run the aligner again
    found = written(search.align(pairs, cut, proteins, aligner, tasks=config.align_tasks or None, long_gene=config.long_gene, long_protein=config.long_protein))
    long_enough = (F.col("type") != "CDS") | F.coalesce(F.col("al_score") >= config.min_exon_score, F.lit(True)) if config.cut_exons else F.lit(True)
    placed = hints.lift(found.where(long_enough).withColumn("seqid", F.lit(None).cast("string")), regions)
    return placed.withColumn("score", F.lit(None).cast("int")), pairs


def full_run(spark: SparkSession, genome_path: str, proteins_path: str, aligner: Callable[[pd.DataFrame], pd.DataFrame], config: EngineConfig) -> Results:
    """From files to results by config: seeds or seeds with pairs, or alignments made elsewhere; with a previous run's files, genes that did not
    change take over its hints and only the others are aligned."""
    proteins = sequences.read_fasta(spark, proteins_path)
    if config.seeds is None:
        raise ValueError("a run needs seeds")
    seeds = features.checked(features.read_genes(spark, config.seeds, strict=True))
    pairs = sequences.read_pairs(spark, config.pairs) if config.pairs else None
    if config.alignments:
        if pairs is None:
            raise ValueError("alignments need the pairs they come from")
        return standard_run(features.read_hints(spark, config.alignments), pairs, config)
    genome = written(sequences.read_pieces(spark, genome_path))
    if not config.previous_seeds:
        raw, pairs = lifted_hints(seeds, genome, proteins, aligner, config, pairs)
        return standard_run(raw, pairs, config)
    old = features.read_genes(spark, config.previous_seeds, strict=True)
    old_hints = features.read_hints(spark, config.previous_alignments)
    known: list[DataFrame] = []

    def fresh(unique: DataFrame) -> DataFrame:
        raw, found = lifted_hints(unique, genome, proteins, aligner, config, pairs)
        known.append(found)
        return raw

    _, raw = next_iteration(seeds, old, old_hints, fresh)
    # reused hints bring their pairs along, in the order in which their proteins were flagged before
    reused = genes.reused_hints(genes.keep_longest(seeds), genes.keep_longest(old), old_hints)
    first = reused.groupBy("gene", "prot").agg(F.min(F.when(F.col("top"), 0).otherwise(1)).alias("place"), F.min("ordinal").alias("first"))
    before = first.withColumn("ordinal", F.row_number().over(Window.partitionBy("gene").orderBy("place", "first"))).select("gene", "prot", "ordinal")
    every = known[0].select("gene", "prot", "ordinal").unionByName(before)
    return standard_run(raw, every, config)


def next_iteration(new_seeds: DataFrame, old_seeds: DataFrame, old_hints: DataFrame, fresh_hints) -> tuple[DataFrame, DataFrame]:
    """(seeds that need work, raw hints of all new seeds): hints of unchanged genes are reused under their new names.

    fresh_hints is called with the seeds that no old gene equals, and returns their raw hints. old_seeds may be the signatures that the run before
    has kept, and old_hints its table of hints: then neither is shuffled (see sources.statistics).
    """
    new, old = genes.keep_longest(new_seeds), old_seeds if "signature" in old_seeds.columns else genes.keep_longest(old_seeds)
    # stored: names alone, for two looks, so that signatures are made once; kept signatures cost no shuffle that this would save
    changed = genes.changed_genes(new, old)
    changed = changed if "signature" in old_seeds.columns else stored(changed.select("gene", "old_gene", "first"), "changed")
    unique = genes.unique_seeds(new, old, changed)
    return unique, fresh_hints(unique).unionByName(genes.reused_hints(new, old, old_hints, changed), allowMissingColumns=True)


def check_inputs(pairs: DataFrame, raw: DataFrame) -> None:
    """Raises if there are no pairs, no hints, hints of unknown pairs, or none of a gene's first protein. Runs small jobs."""
    for what, df in (("pairs", pairs), ("hints", raw)):
        if df.isEmpty():
            raise ValueError(f"no {what}")
    if bad := hints.unknown_pairs(raw, pairs).select("gene", "prot").limit(3).collect():
        raise ValueError(f"hints of unknown pairs: {[tuple(r) for r in bad]}")
    if raw.join(hints.first_pairs(pairs), ["gene", "prot"], "left_semi").isEmpty():
        raise ValueError("no hint of a gene's first protein")
