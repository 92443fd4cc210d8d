"""Seed genes: isoforms, extents, windows, coding sequences, and what changed between two sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hintforge.functions.sequence import reverse_complement, spliced, translate


def transcript_lengths(genes: DataFrame) -> DataFrame:
    """Sum of end - start over coding segments (not one more each) by gene and transcript."""
    return genes.where("type = 'CDS'").groupBy("gene", "tx").agg(F.sum(F.col("end") - F.col("start")).alias("length"), F.min("ordinal").alias("first"))


def longest_isoforms(genes: DataFrame, order=("first", "tx")) -> DataFrame:
    """gene, tx, length of each gene's longest transcript; ties go by `order`, genes of length 0 drop out."""
    w = Window.partitionBy("gene").orderBy(F.desc("length"), *order)
    return transcript_lengths(genes).where("length > 0").withColumn("rank", F.row_number().over(w)).where("rank = 1").select("gene", "tx", "length")


def keep_longest(genes: DataFrame) -> DataFrame:
    """All rows, of any type, of the longest transcripts.

    Rows are moved once, by gene: the lengths of transcripts are sums over windows, so what follows by gene moves nothing.
    """
    coding = lambda c: F.when(F.col("type") == "CDS", c)
    tx = Window.partitionBy("gene", "tx")
    sums = genes.repartition("gene").withColumns({"_length": F.sum(coding(F.col("end") - F.col("start"))).over(tx), "_first": F.min(coding(F.col("ordinal"))).over(tx)})
    order = F.struct((-F.col("_length")).alias("length"), F.col("_first").alias("first"), F.col("tx"))
    best = F.min(F.when(F.col("_length") > 0, order)).over(Window.partitionBy("gene"))
    kept = sums.where("gene IS NOT NULL AND tx IS NOT NULL").withColumn("_best", best["tx"])
    return kept.where("tx = _best").select(*genes.columns)


def extents(genes: DataFrame) -> DataFrame:
    """gene, seqid, strand, left, right over coding segments; start and stop codon places, -1 if there are none."""
    at = lambda kind, c: F.coalesce(F.min(F.when(F.col("type") == kind, F.col(c))), F.lit(-1))
    span = genes.groupBy("gene", "seqid").agg(F.min("strand").alias("strand"), F.min(F.when(F.col("type") == "CDS", F.col("start"))).alias("left"), F.max(F.when(F.col("type") == "CDS", F.col("end"))).alias("right"), at("start_codon", "start").alias("start_codon"), at("stop_codon", "start").alias("stop_codon"))
    return span.where("left IS NOT NULL")


def windows(extent: DataFrame, lengths: DataFrame, margin: int = 2000, max_gene: int = 0) -> DataFrame:
    """extent with left and right widened by margin inside the sequence; longer genes than max_gene go if it isn't 0."""
    kept = extent.where(F.col("right") - F.col("left") + 1 <= max_gene) if max_gene else extent
    joined = kept.join(lengths.select("seqid", F.col("length").alias("_length")), "seqid")
    return joined.withColumns({"left": F.greatest(F.lit(1), F.col("left") - margin), "right": F.least(F.col("_length"), F.col("right") + margin)}).drop("_length")


#: Bases of a chunk of a sequence.
CHUNK_BASES = 1 << 16


def sequence_chunks(genome: DataFrame, size: int = CHUNK_BASES) -> DataFrame:
    """seqid, chunk, part: sequences in pieces of `size` bases, so that no gene carries a whole chromosome through a join.

    A genome that comes in pieces (see sources.sequences.read_pieces) of that size is taken as it is.
    """
    if "chunk" in genome.columns:
        return genome
    last = F.floor((F.length("seq") - 1) / size).cast("int")
    parts = genome.where(F.length("seq") > 0).select(F.col("id").alias("seqid"), "seq", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    return parts.select("seqid", "chunk", F.substring(F.col("seq"), F.col("chunk") * size + 1, F.lit(size)).alias("part"))


def cut_out(spans: DataFrame, genome: DataFrame, key: list[str], size: int = CHUNK_BASES) -> DataFrame:
    """key and seq of spans(key..., seqid, left, right), which key names: each span meets the chunks that it covers, and their cuts are put together.

    Places outside of the sequence give nothing; a span of which no base is there gives no row.
    """
    first, last = (F.floor((F.greatest(F.col(c), F.lit(1)) - 1) / size).cast("int") for c in ("left", "right"))
    covered = spans.where("right >= left AND right >= 1").select(*key, "seqid", "left", "right", F.explode(F.sequence(first, last)).alias("chunk"))
    met = covered.join(sequence_chunks(genome, size), ["seqid", "chunk"])
    from_ = F.greatest(F.col("left") - F.col("chunk") * size, F.lit(1)).cast("int")
    upto = F.least(F.col("right") - F.col("chunk") * size, F.lit(size)).cast("int")
    cuts = met.select(*key, F.struct("chunk", F.substring(F.col("part"), from_, upto - from_ + 1).alias("part")).alias("cut"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("cut")), lambda c: c["part"]), "")
    return cuts.groupBy(*key).agg(joined.alias("seq")).where(F.length("seq") > 0)


def region_sequences(regions: DataFrame, pairs: DataFrame, genome: DataFrame) -> DataFrame:
    """gene, n_pairs, left, right, strand, seqid, seq of the genes that have pairs; reverse-strand regions are reversed and complemented."""
    counted = pairs.groupBy("gene").agg(F.count("*").alias("n_pairs"))
    key = ["gene", "n_pairs", "left", "right", "strand", "seqid"]
    rows = regions.join(counted, "gene").select(*key)
    # left, right and seqid are part of the key and the span
    cut = cut_out(rows.select(F.struct(*key).alias("k"), "seqid", "left", "right"), genome, ["k"])
    return cut.select("k.*", F.when(F.col("k.strand") == "-", reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


def coding_sequences(genes: DataFrame, genome: DataFrame) -> DataFrame:
    """gene, cds, protein: coding segments sorted by place, spliced, in frame, and translated. A phase `.` counts 0."""
    phase = F.coalesce(F.expr("try_cast(phase AS int)"), F.lit(0))
    cds = genes.where("type = 'CDS'").select("gene", "seqid", "strand", F.struct("start", "end", phase.alias("phase")).alias("place"))
    parts = cds.groupBy("gene", "seqid", "strand").agg(F.array_sort(F.collect_list("place")).alias("cds"))
    spans = parts.select("gene", "seqid", "strand", F.posexplode("cds").alias("i", "place"))
    cut = cut_out(spans.select(F.struct("gene", "seqid", "strand", "i").alias("k"), "seqid", F.col("place.start").alias("left"), F.col("place.end").alias("right")), genome, ["k"])
    pieces = cut.groupBy("k.gene", "k.seqid", "k.strand").agg(F.transform(F.array_sort(F.collect_list(F.struct("k.i", "seq"))), lambda c: c["seq"]).alias("pieces"))
    rows = parts.join(pieces, ["gene", "seqid", "strand"])
    coding = spliced(F.col("pieces"), F.col("strand"), F.get("cds", F.lit(0))["phase"], F.element_at("cds", -1)["phase"])
    return rows.select("gene", coding.alias("cds")).withColumn("protein", translate(F.col("cds")))


def signatures(genes: DataFrame) -> DataFrame:
    """gene, signature (all coding segments in order), first: equal signatures are equal genes."""
    segment = F.struct("seqid", "start", "end", "strand", F.coalesce("phase", F.lit(".")).alias("phase"))
    named = lambda c: F.concat_ws("_", *(c[n].cast("string") for n in ("seqid", "start", "end", "strand", "phase")))
    return genes.where("type = 'CDS'").groupBy("gene").agg(F.array_join(F.transform(F.array_sort(F.collect_list(segment)), named), "-").alias("signature"), F.min("ordinal").alias("first"))


def _same(signatures: DataFrame) -> DataFrame:
    """Signatures by a digest of 32 bytes: they grow with a gene's segments, and only their equality counts."""
    return signatures.withColumn("_same", F.unhex(F.sha2("signature", 256)))


def _last(old: DataFrame, key: str) -> DataFrame:
    return old.groupBy(key).agg(F.max_by("gene", F.struct("first", "gene")).alias("old_gene"))


def changed_genes(new: DataFrame, old: DataFrame) -> DataFrame:
    """gene and old_gene of the new genes; old_gene is null where no old gene has the signature, and the last such one (then the last name) where several have.

    old are rows of genes, or their signatures as they were kept (see sources.statistics).
    """
    if "signature" in old.columns:
        return signatures(new).join(_last(old, "signature"), "signature", "left").select("gene", "old_gene", "signature", "first")
    before = _last(_same(signatures(old)).select("gene", "first", "_same"), "_same")
    return _same(signatures(new)).join(before, "_same", "left").select("gene", "old_gene", "signature", "first")


def unique_seeds(new: DataFrame, old: DataFrame, changed: DataFrame | None = None) -> DataFrame:
    """The rows of new genes that no old gene equals. changed: changed_genes(new, old), if it is known."""
    changed = changed_genes(new, old) if changed is None else changed
    return new.join(changed.where("old_gene IS NULL"), "gene", "left_semi")


def reused_hints(new: DataFrame, old: DataFrame, hints: DataFrame, changed: DataFrame | None = None) -> DataFrame:
    """Hints of old genes that a new gene equals, under the new name; of several new names the last stands. changed: as of unique_seeds."""
    changed = changed_genes(new, old) if changed is None else changed
    names = changed.where("old_gene IS NOT NULL").groupBy("old_gene").agg(F.max_by("gene", F.struct("first", "gene")).alias("_gene"))
    joined = hints.join(names, hints["gene"] == names["old_gene"])
    return joined.select(*(F.col("_gene").alias("gene") if c == "gene" else hints[c] for c in hints.columns))
