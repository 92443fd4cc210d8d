"""Hints: combining, overlap of starts, upstream support, top-protein flags, chains. DataFrame in, DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hintforge.config import QUALITY, Cutoffs
from hintforge.functions.scoring import confident, coverage, priority_class, shrunk
from hintforge.storage import stored

KEY = ["seqid", "type", "start", "end", "strand"]


def _has(df: DataFrame, name: str) -> str | None:
    return name if name in df.columns else None


def filter_hints(hints: DataFrame, cutoffs: Cutoffs = Cutoffs()) -> DataFrame:
    """The rows that pass; absent optional columns count as described in `confident`."""
    scored = hints if "score" in hints.columns else hints.withColumn("score", F.lit(None).cast("int"))
    return scored.where(confident(cutoffs, **{c: _has(hints, n) for c, n in {"splice_sites": "splice_sites", "top": "top", "full": "full", "overlap": "cds_overlap"}.items()})).select(*hints.columns)


def combine(hints: DataFrame, *more: str) -> DataFrame:
    """One row for each (seqid, type, start, end, strand): summed coverage, best alignment score, last splice sites, any top flag.

    Where hints has `ordinal`, "last" and "first text of the best score" follow it; else the greatest value stands. A null score counts 1.
    `more` columns keep rows apart that differ in them.
    """
    last = (lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ordinal")))) if _has(hints, "ordinal") else F.max
    out = [F.sum(coverage(F.col("score"))).alias("score") if _has(hints, "score") else F.count("*").alias("score"), F.max("al_score").alias("al_score")]
    out += [last(c).alias(c) for c in ("source", "phase", "splice_sites") if _has(hints, c)]
    if _has(hints, "al_text"):
        first = F.struct("al_score", -F.col("ordinal")) if _has(hints, "ordinal") else F.col("al_score")
        out.append(F.max_by("al_text", F.when(F.col("al_score").isNotNull(), first)).alias("al_text"))
    if _has(hints, "top"):
        out.append(F.coalesce(F.bool_or("top"), F.lit(False)).alias("top"))
    return hints.groupBy(*KEY, *more).agg(*out)


def best_of(hints: DataFrame, kind: str, cutoffs: Cutoffs = QUALITY) -> DataFrame:
    """One type's hints of sufficient quality, combined. The cut comes before the sum: it changes coverage."""
    return combine(filter_hints(hints.where(F.col("type") == kind), cutoffs))


def count_overlaps(starts: DataFrame, cds: DataFrame) -> DataFrame:
    """starts with cds_overlap: the coverage of combined coding segments that hold the start codon strictly inside, on either strand."""
    c = cds.select("seqid", F.col("start").alias("c_start"), F.col("end").alias("c_end"), coverage(F.col("score")).alias("c_score"))
    near = starts.join(c, "seqid").where("c_start < start AND c_end > end")
    return _with_overlap(starts, near)


def count_overlaps_binned(starts: DataFrame, cds: DataFrame, width: int = 10_000) -> DataFrame:
    """As count_overlaps for few long sequences: a segment goes to each bin that it covers, a start to its one bin, so no pair meets twice."""
    c = cds.select("seqid", F.col("start").alias("c_start"), F.col("end").alias("c_end"), coverage(F.col("score")).alias("c_score"))
    c = c.withColumn("bin", F.explode(F.sequence(F.floor(F.col("c_start") / width), F.floor(F.col("c_end") / width))))
    near = starts.withColumn("bin", F.floor(F.col("start") / width)).join(c, ["seqid", "bin"]).where("c_start < start AND c_end > end")
    return _with_overlap(starts, near)


def count_overlaps_summed(starts: DataFrame, cds: DataFrame, width: int = 10_000) -> DataFrame:
    """As count_overlaps, from prefix sums: no start ever meets a segment, so the work follows the rows however deep segments lie on a start.

    The segments around a codon are those that begin before it, less those that end by its end, but for those that lie within it, which
    begin no earlier. Coverage is summed by place, then by bins of `width` places with running sums over the bins of a sequence. Segments no longer than a codon
    meet the few codons that could hold them by place.
    """
    c = cds.select("seqid", "start", "end", coverage(F.col("score")).cast("long").alias("n"))
    row = lambda df, side, at, n, asked: df.select("seqid", F.lit(side).alias("side"), at.alias("at"), n.cast("long").alias("n"), F.lit(asked).alias("asked"))
    begin, end = F.col("start"), F.col("end")
    events = row(c, "begin", begin, F.col("n"), False).unionByName(row(c, "end", end, F.col("n"), False))
    wanted = row(starts, "begin", begin, F.lit(0), True).unionByName(row(starts, "end", end + 1, F.lit(0), True))  # sums of what lies before a place
    places = events.unionByName(wanted).groupBy("seqid", "side", F.floor(F.col("at") / width).alias("bin"), "at").agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = places.withColumn("own", earlier(Window.partitionBy("seqid", "side", "bin").orderBy("at"))).where("asked")
    bins = places.groupBy("seqid", "side", "bin").agg(F.sum("n").alias("n")).select("seqid", "side", "bin", earlier(Window.partitionBy("seqid", "side").orderBy("bin")).alias("base"))
    sums = inside.join(bins, ["seqid", "side", "bin"]).select("seqid", "side", "at", (F.col("own") + F.col("base")).alias("n"))
    side = lambda name, at, n: sums.where(F.col("side") == name).select("seqid", F.col("at").alias(at), F.col("n").alias(n))
    codon = starts.select("seqid", "start", "end").distinct()
    longest = codon.groupBy("seqid").agg(F.max(end - begin + 1).alias("longest"))
    short = c.join(longest, "seqid").where(end - begin < F.col("longest"))
    could = short.select("seqid", F.explode(F.sequence(end - F.col("longest") + 1, begin)).alias("start"), end.alias("_end"), "n")
    within = could.join(codon, ["seqid", "start"]).where("_end <= end").groupBy("seqid", "start", "end").agg(F.sum("n").alias("_within"))
    counted = codon.withColumn("_after", end + 1).join(side("begin", "start", "_begun"), ["seqid", "start"], "left").join(side("end", "_after", "_ended"), ["seqid", "_after"], "left").join(within, ["seqid", "start", "end"], "left")
    zero = lambda name: F.coalesce(name, F.lit(0))
    found = counted.select("seqid", "start", "end", (zero("_begun") - zero("_ended") + zero("_within")).alias("cds_overlap"))
    return starts.drop("cds_overlap").join(found, ["seqid", "start", "end"], "left").withColumn("cds_overlap", zero("cds_overlap")).select(*(x for x in starts.columns if x != "cds_overlap"), "cds_overlap")


def _with_overlap(starts: DataFrame, near: DataFrame) -> DataFrame:
    sums = near.groupBy(*KEY).agg(F.sum("c_score").alias("cds_overlap"))
    base = starts.drop("cds_overlap")
    return base.join(sums, KEY, "left").withColumn("cds_overlap", F.coalesce("cds_overlap", F.lit(0)))


def supported_cds(cds: DataFrame, others: DataFrame, strict: bool = False) -> DataFrame:
    """Coding segments whose upstream end follows an intron of `others` or is a start codon there.

    Positions alone are compared; strict asks for the same sequence and strand as well.
    """
    plus = F.col("strand") == "+"
    introns, opens = others.where("type = 'Intron'"), others.where("type = 'start_codon'")
    behind = F.when(plus, F.col("end")).otherwise(F.col("start"))
    first = F.when(plus, F.col("start")).otherwise(F.col("end"))
    # a spot is where a segment of the strand `p` begins
    if strict:
        spots = introns.select("seqid", plus.alias("p"), F.when(plus, behind + 1).otherwise(behind - 1).alias("spot")).unionByName(opens.select("seqid", plus.alias("p"), first.alias("spot")))
    else:
        either = F.array(F.struct(F.lit(True).alias("p"), F.lit(1).alias("d")), F.struct(F.lit(False).alias("p"), F.lit(-1).alias("d")))
        spots = introns.select(behind.alias("at"), F.inline(either)).select("p", (F.col("at") + F.col("d")).alias("spot")).unionByName(opens.select(F.inline(either).alias("p", "d"), first.alias("spot")).select("p", "spot"))
    key = ["p", "spot"] + ["seqid"] * strict
    return cds.withColumn("p", plus).withColumn("spot", first).join(spots.distinct(), key, "left_semi").select(*cds.columns)


def first_pairs(pairs: DataFrame) -> DataFrame:
    """gene and prot of each gene's best pair, which is its first by ordinal."""
    return pairs.groupBy("gene").agg(F.min_by("prot", "ordinal").alias("prot"))


def listed(pairs: DataFrame, *order) -> DataFrame:
    """pairs with `ordinal`: their place, from 1, among all rows in the order of `order`.

    Rows are sorted within ranges of that order, which are stored with each row's place in its range; a range begins after the rows of those before
    it: a row a range.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = pairs.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_range": F.spark_partition_id(), "_row": row + 1})
    kept = stored(ranged, "listed")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = kept.groupBy("_range").agg(F.count("*").alias("n")).select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    return kept.join(F.broadcast(base), "_range").select(*pairs.columns, (F.col("_base") + F.col("_row")).alias("ordinal"))


def run_starts(pairs: DataFrame, parts: int | None = None) -> DataFrame:
    """The first pair of each run of one gene in file order: equal to first_pairs if each gene's pairs lie together.

    Ordinals, which are distinct, are dealt into `parts` ranges by their quantiles. A range finds its runs by itself, and its first row is compared with the last
    gene of the range before: the driver sees one row for each range.
    """
    n = parts or int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(pairs.approxQuantile("ordinal", [i / n for i in range(1, n)], 0.2 / n))) if n > 1 else []
    part = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("ordinal"))) if bounds else F.lit(0)
    ranged = pairs.withColumn("_part", part)
    last = sorted((r["_part"], r["gene"]) for r in ranged.groupBy("_part").agg(F.max_by("gene", "ordinal").alias("gene")).collect()) if bounds else []
    edges = pairs.sparkSession.createDataFrame([(b, True, a_gene) for (_, a_gene), (b, _) in zip(last, last[1:])], "_part int, _edge boolean, _gene string")
    w = Window.partitionBy("_part").orderBy("ordinal")
    rows = ranged.withColumns({"_row": F.row_number().over(w), "_before": F.lag("gene").over(w)}).join(F.broadcast(edges), "_part", "left")
    first = F.when(F.col("_row") > 1, ~F.col("_before").eqNullSafe(F.col("gene"))).when(F.col("_edge"), ~F.col("_gene").eqNullSafe(F.col("gene"))).otherwise(F.col("gene").isNotNull())
    return rows.where(first).select(*pairs.columns)


def known_top(hints: DataFrame, pairs: DataFrame) -> DataFrame:
    """hints with top: whether their protein is the first of their gene, null for hints of unknown pairs. Hints are moved once."""
    each = pairs.groupBy("gene", "prot").agg(F.min("ordinal").alias("_ordinal"))
    first = F.min_by("prot", "_ordinal").over(Window.partitionBy("gene"))
    known = each.select("gene", "prot", F.coalesce(F.col("prot") == first, F.lit(False)).alias("top"))
    return hints.drop("top").join(known, ["gene", "prot"], "left")


def flag_top(hints: DataFrame, pairs: DataFrame) -> DataFrame:
    """hints with top: whether their protein is the first of their gene. Hints of unknown pairs are left out: see unknown_pairs."""
    return known_top(hints, pairs).where("top IS NOT NULL")


def unknown_pairs(hints: DataFrame, pairs: DataFrame) -> DataFrame:
    """Hints whose (gene, prot) is no pair: a sign of mixed-up inputs."""
    return hints.join(pairs, ["gene", "prot"], "left_anti")


def top_k_targets(pairs: DataFrame, k: int = 25, order=None) -> DataFrame:
    """The best k pairs of each gene, with their rank."""
    w = Window.partitionBy("gene").orderBy(*(order or ["ordinal"]))
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def best_supports(hints: DataFrame, k: int = 1, lexical: bool = False, ties=("gene", "prot")) -> DataFrame:
    """Distinct gene and prot of each feature's k best hints by alignment score; lexical compares scores as text."""
    score = F.col("al_text") if lexical else F.col("al_score")
    w = Window.partitionBy(*KEY).orderBy(score.desc(), *ties)
    return hints.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("gene", "prot").distinct()


def lift(hints: DataFrame, regions: DataFrame) -> DataFrame:
    """hints with coordinates inside their gene's region as coordinates of the sequence. regions(gene, left, right, strand, seqid).

    In a region of the reverse strand, positions count from its right end. Every hint takes its region's strand.
    """
    r = regions.select("gene", "left", "right", F.col("strand").alias("_strand"), F.col("seqid").alias("_seqid"))
    plus = F.col("_strand") == "+"
    start = F.when(plus, F.col("start") + F.col("left") - 1).otherwise(F.col("right") - F.col("end") + 1)
    end = F.when(plus, F.col("end") + F.col("left") - 1).otherwise(F.col("right") - F.col("start") + 1)
    joined = hints.join(r, "gene").withColumns({"_start": start, "_end": end})
    moved = {"start": "_start", "end": "_end", "strand": "_strand", "seqid": "_seqid"}
    return joined.select(*(F.col(moved.get(c, c)).alias(c) for c in hints.columns))


def chains(hints: DataFrame, cut: int = 15, cutoffs: Cutoffs = QUALITY) -> DataFrame:
    """Good hints with coding segments made shorter: evidence of one alignment that belongs together by (prot, gene)."""
    good = filter_hints(hints, cutoffs)
    start, end = shrunk(F.col("start"), F.col("end"), cut)
    is_cds = F.col("type") == "CDS"
    return good.withColumns({"start": F.when(is_cds, start).otherwise(F.col("start")), "end": F.when(is_cds, end).otherwise(F.col("end")), "type": F.when(is_cds, "CDSpart").otherwise(F.col("type"))})


def classify(hints: DataFrame) -> DataFrame:
    """hints with class 2 or 0; coverage is judged against its exact median over all rows."""
    median = hints.agg(F.median("score").alias("_median"))  # one row
    return hints.crossJoin(F.broadcast(median)).withColumn("class", priority_class(F.col("score"), F.col("_median"), F.col("al_score"))).drop("_median")
