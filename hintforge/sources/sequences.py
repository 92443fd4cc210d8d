"""FASTA, pair lists and exon tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hintforge.functions.sequence import clean_dna, clean_protein_line, is_dna, upper_ascii
from hintforge.sources.lines import placed_text


def read_fasta(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    """id (first word of the header) and upper-case sequence; with ids(id), only those. Text before the first header is an error."""
    where = F.col("_metadata")
    records = spark.read.option("lineSep", "\n>").text(path).select("value", (where["file_block_start"] == 0).alias("first_block"), F.monotonically_increasing_id().alias("n"), where["file_path"].alias("file"))
    # Spark hands on a file's first record with its mark, the others without
    begin = records.where("first_block").groupBy("file").agg(F.min("n").alias("n")).withColumn("first", F.lit(True))
    records = records.join(F.broadcast(begin), ["file", "n"], "left").where(~F.col("value").rlike(r"^\s*$"))
    marked = F.coalesce(F.col("first"), F.lit(False)) & ~F.col("value").rlike(r"^\s*>")
    text = F.when(marked, F.raise_error(F.concat(F.lit("text before the first header of "), F.col("file"))).cast("string")).otherwise(F.regexp_replace("value", r"^\s*>", ""))
    records = records.select(text.alias("value"))
    head, body = F.regexp_extract("value", r"^[^\S\n]*(\S*)", 1), F.regexp_replace("value", r"^[^\n]*\n?", "")
    found = records.select(head.alias("id"), F.regexp_replace(upper_ascii(body), "[^A-Z*]", "").alias("seq"), body.alias("raw"))
    return found.join(ids.select("id").distinct(), "id", "left_semi") if ids is not None else found


def read_genome(spark: SparkSession, path: str, mask_lower: bool = False) -> DataFrame:
    """id and seq of ATCGN; other letters are an error when the rows are read."""
    cleaned = read_fasta(spark, path).select("id", clean_dna(F.col("raw"), mask_lower).alias("seq"))
    message = F.concat(F.lit("not DNA: "), F.col("id"))
    return cleaned.withColumn("seq", F.when(is_dna(F.col("seq")), F.col("seq")).otherwise(F.raise_error(message).cast("string")))


def fasta_lines(sequences: DataFrame, least: int = 0) -> DataFrame:
    """Records of more than `least` letters."""
    return sequences.where(F.length("seq") > least).select(F.concat(F.lit(">"), F.col("id"), F.lit("\n"), F.col("seq"), F.lit("\n")).alias("value"))


def write_fasta(sequences: DataFrame, path: str, least: int = 0) -> None:
    fasta_lines(sequences, least).write.text(path)


def clean_proteins(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(clean_protein_line(F.col("value")).alias("value"))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """gene, prot and ordinal: the order of lines is the order of rank. A line of one word is an error when read."""
    text = placed_text(spark, path).select("ordinal", F.trim("value").alias("line")).where("line <> '' AND line NOT LIKE '#%'")
    words = F.split("line", r"\s+")
    prot = F.when(F.size(words) >= 2, F.get(words, F.lit(1))).otherwise(F.raise_error(F.concat(F.lit("not a pair: "), F.col("line"))).cast("string"))
    return text.select(F.get(words, F.lit(0)).alias("gene"), prot.alias("prot"), "ordinal")


def read_exons(spark: SparkSession, path: str) -> DataFrame:
    """Exons of alignments, in file order: prot, gene, prot_start, prot_end, start, end, exon_score, splice_sites."""
    text = placed_text(spark, path).where("value <> '' AND NOT value RLIKE '^[#@]'")
    cell = lambda i: F.get(F.split("value", "\t"), F.lit(i))
    return text.select("ordinal", cell(0).alias("prot"), cell(1).alias("gene"), cell(6).cast("long").alias("prot_start"), cell(7).cast("long").alias("prot_end"), cell(8).cast("long").alias("start"), cell(9).cast("long").alias("end"), cell(10).cast("double").alias("exon_score"), F.get(F.split(F.trim(cell(14)), r"\s+"), F.lit(5)).alias("splice_sites"))


#: Bases of a piece of a sequence.
PIECE_BASES = 1 << 16


def fasta_rows(spark: SparkSession, path: str) -> DataFrame:
    """file, block, n, value: lines of FASTA files; n orders the lines of a block, which is the part of a file that one task reads."""
    meta = F.col("_metadata")
    return spark.read.text(path).select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("n"), "value")


def placed_lines(lines: DataFrame, letters) -> DataFrame:
    """file, record, id, first, part: the lines of sequences, cleaned by `letters`, with the number of letters that stand before them in their record.

    Letters are summed within a block, and blocks of a file hand on their last header and what has followed it: a row a block. So no sequence is
    ever put together to be cut again, and no task holds more than a block. Text before a file's first header is an error.
    """
    head = F.col("value").startswith(">")
    part = F.when(~head, letters(F.regexp_replace("value", r"\r$", "")))
    base = lines.select("file", "block", "n", F.when(head, F.regexp_extract("value", r"^>\s*(\S*)", 1)).alias("id"), part.alias("part")).withColumn("size", F.coalesce(F.length("part"), F.lit(0)))
    w = Window.partitionBy("file", "block").orderBy("n")
    sofar = w.rowsBetween(Window.unboundedPreceding, -1)
    # the header above a line, as far as it is in the block, and the letters since the block began
    seen = base.withColumns({"_record": F.last(F.when(F.col("id").isNotNull(), F.struct("n", "id")), True).over(w), "_sum": F.coalesce(F.sum("size").over(sofar), F.lit(0))})
    run = Window.partitionBy("file", "block", "_record")
    seen = seen.withColumn("_since", F.col("_sum") - F.min("_sum").over(run))
    # only sizes are moved for what blocks hand on
    by_block = base.groupBy("file", "block").agg(F.max(F.when(F.col("id").isNotNull(), F.struct("n", "id"))).alias("last"), F.sum("size").alias("all"))
    after = seen.where(F.col("_record").isNotNull()).groupBy("file", "block", "_record").agg(F.sum("size").alias("tail"))
    tails = by_block.join(after.withColumnRenamed("_record", "last"), ["file", "block", "last"], "left").select("file", "block", "last", F.coalesce("tail", "all").alias("tail"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # letters from the last header's block on: sums up to here less the sums up to there
    ends = tails.withColumns({"_above": F.last("last", True).over(before), "_up": F.coalesce(F.sum("tail").over(before), F.lit(0))})
    ends = ends.withColumn("_from", F.when(F.col("last").isNotNull(), F.col("_up")))
    carried = ends.select("file", "block", "_above", (F.col("_up") - F.last("_from", True).over(before)).alias("_carried"))
    rows = seen.where("part IS NOT NULL AND part <> ''").join(carried, ["file", "block"])
    lost = F.raise_error(F.concat(F.lit("text before the first header of "), F.col("file"))).cast("string")
    record = F.coalesce("_record", "_above")
    first = F.when(F.col("_record").isNotNull(), F.col("_since")).otherwise(F.col("_carried") + F.col("_since"))
    return rows.select("file", record["n"].alias("record"), F.coalesce(record["id"], lost).alias("id"), first.cast("long").alias("first"), "part")


def sequence_pieces(lines: DataFrame, size: int = PIECE_BASES, mask_lower: bool = False, dna: bool = True) -> DataFrame:
    """seqid, chunk, part: the sequences of FASTA lines(file, block, n, value) in pieces of `size` letters; no row ever holds a whole contig.

    As read_genome cleans them: upper-case letters, ambiguous bases as N, other letters an error (dna=False: upper-case letters as they are).
    Only a contig that is written as a single line passes through one row.
    """
    clean = (lambda c: clean_dna(c, mask_lower)) if dna else (lambda c: F.regexp_replace(upper_ascii(c), "[^A-Z*]", ""))
    placed = placed_lines(lines, clean)
    if dna:
        placed = placed.withColumn("part", F.when(is_dna(F.col("part")), F.col("part")).otherwise(F.raise_error(F.concat(F.lit("not DNA: "), F.col("id"))).cast("string")))
    chunk, upto = F.floor(F.col("first") / size), F.floor((F.col("first") + F.length("part") - 1) / size)
    cut = placed.select("*", F.explode(F.sequence(chunk.cast("int"), upto.cast("int"))).alias("chunk"))
    from_ = F.greatest(F.col("chunk").cast("long") * size - F.col("first"), F.lit(0))
    until = F.least((F.col("chunk").cast("long") + 1) * size - F.col("first"), F.length("part").cast("long"))
    bit = F.struct((F.col("first") + from_).alias("at"), F.substring(F.col("part"), (from_ + 1).cast("int"), (until - from_).cast("int")).alias("part"))
    bits = cut.select("file", "record", "id", "chunk", bit.alias("bit")).groupBy("file", "record", "id", "chunk").agg(F.array_sort(F.collect_list("bit")).alias("bits"))
    return bits.select(F.col("id").alias("seqid"), "chunk", F.array_join(F.transform("bits", lambda b: b["part"]), "").alias("part"))


def read_pieces(spark: SparkSession, path: str, mask_lower: bool = False, size: int = PIECE_BASES) -> DataFrame:
    """The genome at path as seqid, chunk, part, read by byte ranges: see sequence_pieces."""
    return sequence_pieces(fasta_rows(spark, path), size, mask_lower)


def piece_lengths(pieces: DataFrame) -> DataFrame:
    """seqid and length of sequences in pieces."""
    return pieces.groupBy("seqid").agg(F.sum(F.length("part")).cast("long").alias("length"))
