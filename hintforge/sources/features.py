"""GFF and GTF text as typed DataFrames, and hints back to text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hintforge.functions.attributes import gff_attribute, gtf_attribute, rendered
from hintforge.sources.lines import placed_text

COLUMNS = "seqid string, source string, type string, start string, end string, score string, strand string, phase string, attrs string"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """ordinal (the place in the files) and line."""
    return placed_text(spark, path).withColumnRenamed("value", "line")


def _once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """df with value under name as a row of its own: conditions on it stay behind it, so it isn't worked out again for each of them."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _rows(lines: DataFrame) -> DataFrame:
    """Tab-separated cells of lines(ordinal, line); blank lines and comments go."""
    plain = F.when(F.col("_line").contains("\r"), F.regexp_replace("_line", r"\r$", "")).otherwise(F.col("_line"))
    text = _once(lines.select("ordinal", "line"), F.col("line"), "_line").select("ordinal", plain.alias("line"))
    text = _once(text.where(~F.col("line").rlike(r"^\s*(#|$)")), F.split("line", "\t"), "cells")
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return text.select("ordinal", "line", F.size("cells").alias("n_cells"), *(F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)))


def _valid(rows: DataFrame) -> DataFrame:
    well = (F.col("n_cells") == 9) & F.col("start").rlike("^[0-9]+$") & F.col("end").rlike("^[0-9]+$") & F.col("strand").isin("+", "-")
    return rows.withColumn("valid", F.coalesce(well, F.lit(False)))


def malformed(spark: SparkSession, path: str) -> DataFrame:
    """Lines that aren't features."""
    return malformed_lines(numbered_lines(spark, path))


def malformed_lines(lines: DataFrame) -> DataFrame:
    return _valid(_rows(lines)).where("NOT valid").select("ordinal", "line")


def read_hints(spark: SparkSession, path: str) -> DataFrame:
    """Well-formed features with their attributes as columns; `ordinal` is the place in the file, al_text the score as written."""
    return parsed_hints(numbered_lines(spark, path))


def parsed_hints(lines: DataFrame) -> DataFrame:
    """read_hints of lines(ordinal, line)."""
    rows = _valid(_rows(lines)).where("valid")
    get = lambda name: gff_attribute(F.col("attrs"), name)
    return rows.select(
        "ordinal", "seqid", "source", "type", F.col("start").cast("long"), F.col("end").cast("long"), F.expr("try_cast(score AS int)").alias("score"), "strand", "phase",
        get("prot").alias("prot"), get("seed_gene_id").alias("gene"), F.expr("try_cast(nullif(regexp_extract(attrs, '(?:^|[; ])al_score=([^;]+)', 1), '') AS double)").alias("al_score"), get("al_score").alias("al_text"),
        get("splice_sites").alias("splice_sites"), F.coalesce(get("topProt") == "TRUE", F.lit(False)).alias("top"), F.coalesce(get("fullProteinAligned") == "TRUE", F.lit(False)).alias("full"), get("CDS_overlap").cast("int").alias("cds_overlap"),
    )


def read_genes(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Seed genes: ordinal, seqid, type, start, end, strand, phase, gene, tx. Lines that aren't features are left out, or, if strict, an error when
    the rows are read."""
    return parsed_genes(numbered_lines(spark, path), strict)


def parsed_genes(lines: DataFrame, strict: bool = False) -> DataFrame:
    """read_genes of lines(ordinal, line)."""
    rows = _valid(_rows(lines))
    if strict:
        rows = rows.withColumn("seqid", F.when(F.col("valid"), F.col("seqid")).otherwise(F.raise_error(F.concat(F.lit("not a feature: "), F.col("line"))).cast("string")))
    rows = rows if strict else rows.where("valid")
    return rows.select("ordinal", "seqid", "type", F.col("start").cast("long"), F.col("end").cast("long"), "strand", "phase", gtf_attribute(F.col("attrs"), "gene_id").alias("gene"), gtf_attribute(F.col("attrs"), "transcript_id").alias("tx"))


def gene_faults(genes: DataFrame) -> DataFrame:
    """Genes on several strands or sequences, with several start or stop codons, and rows without a gene: one row for each gene with a fault."""
    counts = genes.groupBy("gene").agg(
        F.countDistinct("strand").alias("strands"), F.countDistinct("seqid").alias("seqids"), F.count_if(F.col("type") == "start_codon").alias("starts"), F.count_if(F.col("type") == "stop_codon").alias("stops")
    )
    return counts.where("gene IS NULL OR strands > 1 OR seqids > 1 OR starts > 1 OR stops > 1")


def checked(genes: DataFrame) -> DataFrame:
    """genes, or an error that names some faulty ones. Runs a job."""
    if bad := gene_faults(genes).limit(5).collect():
        raise ValueError(f"faulty genes: {[r.asDict() for r in bad]}")
    return genes


def hint_lines(hints: DataFrame, source: str = "protein_hint") -> DataFrame:
    """Combined hints as lines of nine columns."""
    has = lambda name: F.col(name) if name in hints.columns else F.lit(None)
    al = F.coalesce(has("al_text"), has("al_score").cast("string"))
    attrs = rendered(al_score=al, splice_sites=has("splice_sites"), topProt=F.when(has("top").cast("boolean"), F.lit("TRUE")), CDS_overlap=has("cds_overlap"))
    phase = F.coalesce(has("phase").cast("string"), F.lit("."))
    return hints.select(F.concat_ws("\t", "seqid", F.lit(source), "type", "start", "end", F.coalesce(F.col("score").cast("string"), F.lit("1")), "strand", phase, attrs).alias("value"))


def write_hints(hints: DataFrame, path: str, source: str = "protein_hint") -> None:
    hint_lines(hints.orderBy("seqid", "start", "end", "type", "strand"), source).write.text(path)
