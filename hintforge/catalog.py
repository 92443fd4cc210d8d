"""All driver-facing queries of the protein-hint engine, and the same in SQL for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hintforge import adapter
from hintforge.config import QUALITY, Cutoffs
from hintforge.functions.attributes import gff_attribute
from hintforge.functions.sequence import clean_dna, clean_protein_line, codons, reverse_complement, translate
from hintforge.operators import exons, genes, hints, search
from hintforge.plans import standard
from hintforge.sources import sequences
from hintforge.sources.features import gene_faults, hint_lines, parsed_genes, parsed_hints, read_hints, write_hints
from hintforge.sources.features import malformed_lines as features_malformed
from hintforge.sources.sequences import fasta_lines
from hintforge.streaming import combined

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

H = """h AS (SELECT 'chr' || CAST(l_suppkey % 5 AS varchar) AS seqid, CASE l_linenumber % 4 WHEN 0 THEN 'CDS' WHEN 1 THEN 'Intron' WHEN 2 THEN 'start_codon' ELSE 'stop_codon' END AS type,
  l_partkey % 200 * 30 + 1 AS s, CAST(CASE l_linenumber % 4 WHEN 0 THEN l_partkey % 200 * 30 + 3 * CAST(l_quantity AS int) WHEN 1 THEN l_partkey % 200 * 30 + 30 * (1 + l_suppkey % 3) ELSE l_partkey % 200 * 30 + 3 END AS bigint) AS e,
  CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, CAST(round(l_discount * 100) AS int) / 25.0::double AS al,
  CASE l_partkey % 10 WHEN 0 THEN 'gc_ag' WHEN 1 THEN 'at_ac' ELSE 'gt_ag' END AS ss, 'p' || CAST(l_suppkey AS varchar) AS prot, 'g' || CAST(l_orderkey % 500 AS varchar) AS gene FROM lineitem)"""
COMB = f"""{H}, comb AS (SELECT seqid, type, s, e, strand, count(*) AS score, max(al) AS al, max(ss) AS ss FROM h
  WHERE CASE type WHEN 'Intron' THEN al >= 0.1 WHEN 'CDS' THEN true ELSE al >= 0.01 END GROUP BY seqid, type, s, e, strand)"""
PAIRS = "pairs AS (SELECT 'g' || CAST(l_orderkey % 500 AS varchar) AS gene, 'p' || CAST(l_suppkey AS varchar) AS prot, CAST(sum(CAST(round(l_extendedprice * 100) AS bigint)) AS bigint) AS sc FROM lineitem GROUP BY 1, 2)"
HC = "CASE type WHEN 'Intron' THEN (ss IS NULL OR ss = 'gt_ag') AND score >= 4 AND al >= 0.25 WHEN 'CDS' THEN true ELSE score >= 4 AND al >= 0.01 END"


def gtf_sql(name: str, moved: int = 0) -> str:
    shift = f"CASE WHEN l_linenumber = {moved} THEN 3 ELSE 0 END"
    return f"""{name} AS (SELECT 'chr' || CAST(l_suppkey % 5 AS varchar) AS seqid, l_partkey * 30 + 1 + {shift} AS s, l_partkey * 30 + 3 * CAST(l_quantity AS int) + {shift} AS e, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand,
  CAST(l_linenumber % 3 AS varchar) AS phase, 'g' || CAST(l_orderkey AS varchar) AS gene, 't' || CAST(l_orderkey AS varchar) || '_' || CAST(l_suppkey % 2 AS varchar) AS tx, l_linenumber AS ln FROM lineitem)"""


BASES = "translate(regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '[^A-Z]', '', 'g'), 'BDEFHIJKLMOPQRSUVWXYZ', 'ACGTACGTACGTACGTACGTA')"
DNA = f"dna AS (SELECT doc_id, {BASES} AS d FROM documents)"


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def short(df: DataFrame) -> DataFrame:
    """Column names as the SQL has them: start and end are awkward words there."""
    return df.withColumnsRenamed({"start": "s", "end": "e", "al_score": "al", "splice_sites": "ss"})


def comb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hints.combine(hints.filter_hints(adapter.raw_hints(spark, sf_dir), QUALITY))


# hints with a phase: `.` of introns, 0 of codons, 0 to 2 of coding segments; of combined ones the greatest
PHASE = "CASE l_linenumber % 4 WHEN 0 THEN CAST(l_suppkey % 3 AS varchar) WHEN 1 THEN '.' ELSE '0' END AS phase"
PHASED = f"{H.replace(' FROM lineitem)', f', {PHASE} FROM lineitem)')}, comb AS (SELECT seqid, type, s, e, strand, count(*) AS score, max(al) AS al, max(phase) AS phase, max(ss) AS ss FROM h WHERE CASE type WHEN 'Intron' THEN al >= 0.1 WHEN 'CDS' THEN true ELSE al >= 0.01 END GROUP BY seqid, type, s, e, strand)"


def of(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("type") == kind)


@query(f"WITH {COMB} SELECT * FROM comb")
def combine(spark, sf_dir):
    return short(comb(spark, sf_dir))


# genes whose number is divisible by 3 change to hints 30 places on, then those divisible by 7 go
LATER = H.replace("h AS (SELECT", "h0 AS (SELECT l_orderkey % 500 AS k,", 1) + ", h AS (SELECT seqid, type, s + CASE WHEN k % 3 = 0 THEN 30 ELSE 0 END AS s, e + CASE WHEN k % 3 = 0 THEN 30 ELSE 0 END AS e, strand, al, ss FROM h0 WHERE k % 7 <> 0)"


@query(f"WITH {LATER} SELECT seqid, type, s, e, strand, count(*) AS score, max(al) AS al, max(ss) AS ss FROM h GROUP BY seqid, type, s, e, strand")
def combined_updates(spark, sf_dir):
    """Combined hints after three batches: all genes, some genes changed, some gone."""
    raw = adapter.raw_hints(spark, sf_dir).select("gene", *hints.KEY, "al_score", "splice_sites")
    number = F.substring("gene", 2, 9).cast("long")
    path = combined.state_path(spark, "combined")
    combined.apply_batch(raw, path, 0)
    combined.apply_batch(raw.where(number % 3 == 0).withColumns({c: F.col(c) + 30 for c in ("start", "end")}), path, 1)
    combined.apply_batch(raw.limit(0), path, 2, raw.where(number % 7 == 0).select("gene"))
    return short(combined.combined_state(spark, path, "seqid string, type string, start long, end long, strand string, score long, al_score double, splice_sites string"))


@query(f"WITH {COMB} SELECT * FROM comb WHERE {HC}")
def high_confidence(spark, sf_dir):
    return short(hints.filter_hints(comb(spark, sf_dir)))


@query(f"WITH {COMB} SELECT * FROM comb WHERE CASE type WHEN 'Intron' THEN ss IN ('gt_ag', 'gc_ag') AND score >= 2 AND al >= 0.1 WHEN 'CDS' THEN true WHEN 'stop_codon' THEN score >= 6 AND al >= 0.2 ELSE score >= 5 AND al >= 0.3 END")
def high_confidence_custom(spark, sf_dir):
    """The same filter with a user's own thresholds."""
    return short(hints.filter_hints(comb(spark, sf_dir), Cutoffs(2, 5, 6, 0.1, 0.3, 0.2, gc_ag=True)))


SUPPORT = f"""WITH {COMB}, ie AS (SELECT seqid, strand, CASE WHEN strand = '+' THEN e ELSE s END AS p FROM comb WHERE type = 'Intron'),
st AS (SELECT seqid, strand, CASE WHEN strand = '+' THEN s ELSE e END AS p FROM comb WHERE type = 'start_codon')"""


@query(f"{SUPPORT} SELECT * FROM comb WHERE type = 'CDS' AND CASE WHEN strand = '+' THEN s - 1 IN (SELECT p FROM ie) OR s IN (SELECT p FROM st) ELSE e + 1 IN (SELECT p FROM ie) OR e IN (SELECT p FROM st) END")
def upstream_support(spark, sf_dir):
    c = comb(spark, sf_dir)
    return short(hints.supported_cds(of(c, "CDS"), c))


@query(f"{SUPPORT} SELECT * FROM comb c WHERE type = 'CDS' AND (EXISTS (SELECT 1 FROM ie WHERE ie.seqid = c.seqid AND ie.strand = c.strand AND ie.p = CASE WHEN c.strand = '+' THEN c.s - 1 ELSE c.e + 1 END) OR EXISTS (SELECT 1 FROM st WHERE st.seqid = c.seqid AND st.strand = c.strand AND st.p = CASE WHEN c.strand = '+' THEN c.s ELSE c.e END))")
def upstream_support_strict(spark, sf_dir):
    c = comb(spark, sf_dir)
    return short(hints.supported_cds(of(c, "CDS"), c, strict=True))


OVERLAP = "SELECT t.seqid, t.type, t.s, t.e, t.strand, t.score, t.al, t.ss, CAST(coalesce(sum(c.score), 0) AS bigint) AS cds_overlap FROM {starts} t LEFT JOIN {cds} c ON c.seqid = t.seqid AND c.s < t.s AND c.e > t.e AND c.type = 'CDS' WHERE t.type = 'start_codon' GROUP BY ALL"


@query(f"WITH {COMB} {OVERLAP.format(starts='comb', cds='comb')}")
def cds_overlap(spark, sf_dir):
    c = comb(spark, sf_dir)
    return short(hints.count_overlaps(of(c, "start_codon"), of(c, "CDS")))


@query(f"WITH {COMB} {OVERLAP.format(starts='comb', cds='comb')}")
def cds_overlap_binned(spark, sf_dir):
    c = comb(spark, sf_dir)
    return short(hints.count_overlaps_binned(of(c, "start_codon"), of(c, "CDS"), 500))


@query(f"WITH {COMB} {OVERLAP.format(starts='comb', cds='comb')}")
def cds_overlap_summed(spark, sf_dir):
    """The same without any pair of a start and a segment."""
    c = comb(spark, sf_dir)
    return short(hints.count_overlaps_summed(of(c, "start_codon"), of(c, "CDS"), 500))


LOGREG = "SELECT c.*, CAST(CASE WHEN -4.00529 + 4.73909 * (score / m) + 9.09026 * al >= 0.85 THEN 2 ELSE 0 END AS int) AS class FROM comb c, (SELECT median(score) AS m FROM comb WHERE type <> 'CDS') WHERE type <> 'CDS'"


@query(f"WITH {COMB} {LOGREG}")
def logreg_class(spark, sf_dir):
    return short(hints.classify(comb(spark, sf_dir).where("type <> 'CDS'")))


@query(f"WITH {COMB}, c AS ({LOGREG}) SELECT class, type, count(*) AS n FROM c GROUP BY class, type")
def class_hist(spark, sf_dir):
    return hints.classify(comb(spark, sf_dir).where("type <> 'CDS'")).groupBy("class", "type").agg(F.count("*").alias("n"))


@query(f"WITH {PAIRS} SELECT gene, prot, sc, CAST(r AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY sc DESC, prot) AS r FROM pairs) WHERE r <= 25")
def topk_pairs(spark, sf_dir):
    return hints.top_k_targets(adapter.ranked_pairs(spark, sf_dir), 25, [F.desc("score"), F.col("prot")]).withColumnRenamed("score", "sc")


def ordered_pairs(spark, sf_dir) -> DataFrame:
    """Pairs with their rank as ordinal."""
    return hints.top_k_targets(adapter.ranked_pairs(spark, sf_dir), 2**31 - 1, [F.desc("score"), F.col("prot")]).withColumnRenamed("rank", "ordinal")


TOP = "top AS (SELECT gene, prot FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY sc DESC, prot) AS r FROM pairs) WHERE r = 1)"


@query(f"WITH {H}, {PAIRS}, {TOP} SELECT h.*, top.prot IS NOT NULL AS top FROM h JOIN pairs USING (gene, prot) LEFT JOIN top USING (gene, prot)")
def flag_top(spark, sf_dir):
    return short(hints.flag_top(adapter.raw_hints(spark, sf_dir), ordered_pairs(spark, sf_dir)))


@query(f"WITH {H}, {PAIRS} SELECT DISTINCT h.gene, h.prot FROM h ANTI JOIN (SELECT * FROM pairs WHERE sc > 5000000) p ON p.gene = h.gene AND p.prot = h.prot")
def unknown_pairs(spark, sf_dir):
    """Hints of pairs that a stricter search would not have found."""
    return hints.unknown_pairs(adapter.raw_hints(spark, sf_dir), adapter.ranked_pairs(spark, sf_dir).where("score > 5000000")).select("gene", "prot").distinct()


@query(f"WITH {H} SELECT DISTINCT gene, prot FROM (SELECT *, row_number() OVER (PARTITION BY seqid, type, s, e, strand ORDER BY al DESC, gene, prot) AS r FROM h) WHERE r <= 2")
def best_k(spark, sf_dir):
    return hints.best_supports(adapter.raw_hints(spark, sf_dir), 2)


CHAINS = """ch AS (SELECT seqid, CASE WHEN type = 'CDS' THEN 'CDSpart' ELSE type END AS type,
  CASE WHEN type <> 'CDS' THEN s WHEN e - s + 1 < 33 THEN s + (e - s + 1) // 6 * 3 ELSE s + 15 END AS s, CASE WHEN type <> 'CDS' THEN e WHEN e - s + 1 < 33 THEN s + (e - s + 1) // 6 * 3 + 2 ELSE e - 15 END AS e,
  strand, al, ss, prot, gene{more} FROM h WHERE CASE type WHEN 'Intron' THEN al >= 0.1 WHEN 'CDS' THEN true ELSE al >= 0.01 END)"""


@query(f"WITH {H}, {CHAINS.format(more='')} SELECT * FROM ch")
def chains(spark, sf_dir):
    return short(hints.chains(adapter.raw_hints(spark, sf_dir)))


KIND = "CASE type WHEN 'Intron' THEN 'intron' WHEN 'start_codon' THEN 'start' WHEN 'stop_codon' THEN 'stop' ELSE type END AS type"


EXPORT = f"""{PHASED}, {CHAINS.format(more=', phase')}, c AS ({LOGREG}), x AS (
SELECT seqid, {KIND}, s, e, strand, phase, 'P' AS src, score AS mult, class, al, NULL AS grp FROM c
UNION ALL SELECT seqid, {KIND}, s, e, strand, phase, 'M', score, NULL, NULL, NULL FROM comb WHERE type <> 'CDS' AND {HC}
UNION ALL SELECT seqid, {KIND}, s, e, strand, phase, 'C', 1, NULL, NULL, prot || '_' || gene FROM ch)"""


def export(spark, sf_dir) -> DataFrame:
    raw = adapter.raw_hints(spark, sf_dir, phase=True)
    c = hints.combine(hints.filter_hints(raw, QUALITY)).where("type <> 'CDS'")
    return standard.exported(c, hints.filter_hints(c), hints.chains(raw))


@query(f"WITH {EXPORT} SELECT * FROM x")
def export_union(spark, sf_dir):
    """All sources with their phases; the text of the score and the source's name are left out, as these tables have none."""
    return short(export(spark, sf_dir).drop("al_text", "source"))


@query(f"""WITH {EXPORT} SELECT seqid || chr(9) || 'protein_hint' || chr(9) || type || chr(9) || s || chr(9) || e || chr(9) || CASE src WHEN 'P' THEN class WHEN 'M' THEN mult ELSE 1 END || chr(9) || strand || chr(9) || phase || chr(9) ||
  CASE src WHEN 'P' THEN 'src=P;mult=' || mult || ';pri=4;al_score=' || CAST(round(al * 100) AS int) || ';' WHEN 'M' THEN 'src=M;mult=' || mult || ';pri=4' ELSE 'grp=' || grp || ';src=C;pri=4;' END AS value FROM x""")
def export_text(spark, sf_dir):
    """The export's lines; the score's text is in hundredths, as engines write doubles in different ways."""
    return standard.export_lines(export(spark, sf_dir).withColumn("al_text", F.round(F.col("al_score") * 100).cast("int").cast("string")))


GTF = gtf_sql("gtf")
LENGTHS = "len AS (SELECT gene, tx, sum(e - s) AS length, min(ln) AS f FROM gtf GROUP BY gene, tx), best AS (SELECT gene, tx, CAST(length AS bigint) AS length FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY length DESC, tx) AS r FROM len WHERE length > 0) WHERE r = 1)"


@query(f"WITH {GTF}, {LENGTHS} SELECT * FROM best")
def longest_isoform(spark, sf_dir):
    return genes.longest_isoforms(adapter.genes(spark, sf_dir), order=("tx",))


@query(f"WITH {GTF}, {LENGTHS.replace('DESC, tx', 'DESC, f, tx')} SELECT seqid, s, e, strand, phase, gene, tx, ln AS ordinal, 'CDS' AS type FROM gtf SEMI JOIN best USING (gene, tx)")
def keep_longest(spark, sf_dir):
    """All rows of the longest isoforms; of equal ones that with the first line, then the first name."""
    return short(genes.keep_longest(adapter.genes(spark, sf_dir)))


SPAN = "span AS (SELECT gene, seqid, min(strand) AS strand, min(s) AS l, max(e) AS r FROM gtf GROUP BY gene, seqid)"


@query(f"WITH {GTF}, {SPAN} SELECT gene, seqid, strand, greatest(1, l - 2000) AS l, least(m, r + 2000) AS r FROM span JOIN (SELECT seqid, max(e) AS m FROM gtf GROUP BY seqid) USING (seqid)")
def gene_extent(spark, sf_dir):
    g = adapter.genes(spark, sf_dir)
    lengths = g.groupBy("seqid").agg(F.max("end").alias("length"))
    return genes.windows(genes.extents(g), lengths).select("gene", "seqid", "strand", F.col("left").alias("l"), F.col("right").alias("r"))


@query(f"WITH {GTF}, {SPAN} SELECT gene, seqid, strand, l, r FROM span WHERE r - l + 1 <= 20000")
def short_genes(spark, sf_dir):
    g = genes.extents(adapter.genes(spark, sf_dir))
    everywhere = g.select("seqid").distinct().withColumn("length", F.lit(2**40))
    return genes.windows(g, everywhere, margin=0, max_gene=20000).select("gene", "seqid", "strand", F.col("left").alias("l"), F.col("right").alias("r"))


@query(
    f"""WITH {H}, w AS (SELECT gene, min(s) AS l, max(e) AS r, min(strand) AS strand, min(seqid) AS seqid FROM h GROUP BY gene)
SELECT w.seqid, type, CASE WHEN w.strand = '+' THEN s + l - 1 ELSE r - e + 1 END AS s, CASE WHEN w.strand = '+' THEN e + l - 1 ELSE r - s + 1 END AS e, w.strand, al, ss, prot, gene FROM h JOIN w USING (gene)"""
)
def region_to_contig(spark, sf_dir):
    h = adapter.raw_hints(spark, sf_dir)
    regions = h.groupBy("gene").agg(F.min("start").alias("left"), F.max("end").alias("right"), F.min("strand").alias("strand"), F.min("seqid").alias("seqid"))
    return short(hints.lift(h, regions))


SIGNATURES = ", ".join(f"{n} AS (SELECT gene, string_agg(seqid || '_' || s || '_' || e || '_' || strand || '_' || phase, '-' ORDER BY seqid, s, e, strand, phase) AS sig, min(ln) AS f FROM {t} GROUP BY gene)" for n, t in (("sn", "gn"), ("so", "go")))
LAST = "arg_max(gene, (f, gene))"
#: Of old genes with one signature the last one's rows are reused, under the last equal new gene's name.
SAME = f"same AS (SELECT o.old, n.gene FROM (SELECT sig, {LAST} AS old FROM so GROUP BY sig) o JOIN (SELECT sig, {LAST} AS gene FROM sn GROUP BY sig) n USING (sig))"
TWO = f"{gtf_sql('gn', 6)}, {gtf_sql('go', 7)}, {SIGNATURES}"


@query(f"WITH {TWO} SELECT gene, o.g AS old_gene, sig AS signature FROM sn LEFT JOIN (SELECT sig, {LAST} AS g FROM so GROUP BY sig) o USING (sig)")
def iter_select(spark, sf_dir):
    """New genes with the old gene that they equal; the last one where several do."""
    new, old = (adapter.genes(spark, sf_dir, k) for k in (6, 7))
    return genes.changed_genes(new, old).select("gene", "old_gene", "signature")


@query(f"WITH {TWO} SELECT seqid, s, e, strand, phase, gene, tx, ln AS ordinal, 'CDS' AS type FROM gn WHERE gene IN (SELECT gene FROM sn WHERE sig NOT IN (SELECT sig FROM so))")
def unique_seeds(spark, sf_dir):
    return short(genes.unique_seeds(adapter.genes(spark, sf_dir, 6), adapter.genes(spark, sf_dir, 7)))


@query(f"WITH {TWO}, {SAME} SELECT go.seqid, s, e, strand, phase, same.gene, tx, ln AS ordinal, 'CDS' AS type FROM go JOIN same ON go.gene = same.old")
def iter_rename(spark, sf_dir):
    """Rows of old genes under the names of equal new ones."""
    return short(genes.reused_hints(adapter.genes(spark, sf_dir, 6), adapter.genes(spark, sf_dir, 7), adapter.genes(spark, sf_dir, 7)))


@query(f"WITH {H} SELECT prot, gene, seqid, strand, pe + 1 AS s, s - 1 AS e FROM (SELECT *, lag(e) OVER w AS pe, lag(al) OVER w AS pal FROM h WHERE type = 'CDS' AND e >= s WINDOW w AS (PARTITION BY prot, gene, seqid, strand ORDER BY s, e, al)) WHERE al >= 0.1 AND pal >= 0.1")
def lag_introns(spark, sf_dir):
    cds = of(adapter.raw_hints(spark, sf_dir), "CDS")
    return short(exons.introns(cds, 0.1, ("prot", "gene", "seqid", "strand"), ("start", "end", "al_score"), "al_score"))


@query(f"WITH {H} SELECT type, strand, count(*) AS n, min(s) AS first, max(e) AS last, max(al) AS best FROM h GROUP BY type, strand")
def hint_profile(spark, sf_dir):
    return adapter.raw_hints(spark, sf_dir).groupBy("type", "strand").agg(F.count("*").alias("n"), F.min("start").alias("first"), F.max("end").alias("last"), F.max("al_score").alias("best"))


@query(f"WITH {GTF} SELECT gene, count(DISTINCT strand) AS strands, count(DISTINCT seqid) AS seqids, 0::bigint AS starts, 0::bigint AS stops FROM gtf GROUP BY gene HAVING count(DISTINCT strand) > 1 OR count(DISTINCT seqid) > 1")
def seed_faults(spark, sf_dir):
    return gene_faults(adapter.genes(spark, sf_dir))


@query(r"SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l: replace(regexp_replace(l, '^([^.]*)[.]', '\1'), '|', '_')), chr(10)) AS cleaned FROM documents")
def clean_text(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", clean_protein_line(F.col("text")).alias("cleaned"))


@query(f"WITH {DNA} SELECT doc_id, length(d) AS n, md5(d) AS digest FROM dna")
def dna(spark, sf_dir):
    return adapter.dna(spark, sf_dir).select(F.col("id").alias("doc_id"), F.length("seq").cast("long").alias("n"), F.md5("seq").alias("digest"))


@query(f"WITH {DNA} SELECT doc_id, reverse(translate(d, 'ACGT', 'TGCA')) AS rc FROM dna")
def revcomp(spark, sf_dir):
    return adapter.dna(spark, sf_dir).select(F.col("id").alias("doc_id"), reverse_complement(F.col("seq")).alias("rc"))


CODE = "map {" + ", ".join(f"'{a}{b}{c}': '{acid}'" for (a, b, c), acid in zip(((x, y, z) for x in "TCAG" for y in "TCAG" for z in "TCAG"), "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG")) + "}"


@query(f"WITH {DNA}, a AS (SELECT doc_id, array_to_string(list_transform(range(1, length(d) - length(d) % 3, 3), lambda i: coalesce({CODE}[d[i:i + 2]], 'X')), '') AS p FROM dna) SELECT doc_id, regexp_replace(p, '[*]$', '') AS protein FROM a")
def translate_dna(spark, sf_dir):
    return adapter.dna(spark, sf_dir).select(F.col("id").alias("doc_id"), translate(F.col("seq")).alias("protein"))


@query(f"WITH {DNA}, c AS (SELECT doc_id, list_transform(range(1, length(d) - length(d) % 3, 3), lambda i: d[i:i + 2]) AS c FROM dna) SELECT doc_id, len(c) AS codons, len(list_filter(c, lambda x: x = 'ATG')) AS starts, len(list_filter(c, lambda x: x IN ('TAA', 'TAG', 'TGA'))) AS stops FROM c")
def orf_counts(spark, sf_dir):
    c = codons(F.col("seq"))
    some = adapter.dna(spark, sf_dir).select(F.col("id").alias("doc_id"), c.alias("c"))
    return some.select("doc_id", F.size("c").cast("long").alias("codons"), F.size(F.filter("c", lambda x: x == "ATG")).cast("long").alias("starts"), F.size(F.filter("c", lambda x: x.isin("TAA", "TAG", "TGA"))).cast("long").alias("stops"))


@query(f"WITH {COMB} SELECT seqid || chr(9) || 'protein_hint' || chr(9) || type || chr(9) || s || chr(9) || e || chr(9) || score || chr(9) || strand || chr(9) || '.' || chr(9) || 'splice_sites=' || ss || ';' AS value, ss AS parsed FROM comb")
def gff_text(spark, sf_dir):
    """Hints as lines, and an attribute read back from them; without the score, which engines write in different ways."""
    lines = hint_lines(comb(spark, sf_dir).drop("al_score"))
    return lines.withColumn("parsed", gff_attribute(F.get(F.split("value", "\t"), F.lit(8)), "splice_sites"))


@query(f"WITH {PAIRS} SELECT gene, count(*) AS n_pairs FROM pairs GROUP BY gene")
def pair_counts(spark, sf_dir):
    return adapter.ranked_pairs(spark, sf_dir).groupBy("gene").agg(F.count("*").alias("n_pairs"))


EVIDENCE = f"""{SUPPORT}, sup AS (SELECT * FROM comb WHERE type = 'CDS' AND CASE WHEN strand = '+' THEN s - 1 IN (SELECT p FROM ie) OR s IN (SELECT p FROM st) ELSE e + 1 IN (SELECT p FROM ie) OR e IN (SELECT p FROM st) END),
ov AS ({OVERLAP.format(starts='comb', cds='sup')})
SELECT seqid, type, s, e, strand, score, al, ss, NULL::bigint AS cds_overlap FROM comb WHERE type IN ('Intron', 'stop_codon') AND {HC} UNION ALL SELECT * FROM ov WHERE score >= 4 AND al >= 0.01 AND cds_overlap <= 0"""


@query(EVIDENCE)
def evidence_pipeline(spark, sf_dir):
    """Raw hints to high-confidence evidence in one plan: cut, combine, support, overlap, filter."""
    return short(hints.filter_hints(standard.combined_hints(adapter.raw_hints(spark, sf_dir))))


@query(
    f"""WITH {DNA}, c AS (SELECT doc_id, d[1:length(d) // 4] || d[length(d) // 2:length(d) - length(d) // 4] AS j FROM dna WHERE length(d) >= 12),
r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN j[doc_id % 3 + 1:] ELSE reverse(translate(j, 'ACGT', 'TGCA'))[doc_id // 3 % 3 + 1:] END AS c FROM c), t AS (SELECT doc_id, c[1:length(c) - length(c) % 3] AS c FROM r),
a AS (SELECT doc_id, c, array_to_string(list_transform(range(1, length(c), 3), lambda i: coalesce({CODE}[c[i:i + 2]], 'X')), '') AS p FROM t)
SELECT 'd' || doc_id AS gene, md5(c) AS digest, regexp_replace(p, '[*]$', '') AS protein FROM a"""
)
def coding_sequences(spark, sf_dir):
    """Two segments a gene, spliced, brought into frame on either strand and translated."""
    genome = adapter.dna(spark, sf_dir)
    found = genes.coding_sequences(adapter.sequence_genes(genome), genome.withColumn("id", F.col("id").cast("string")))
    return found.select("gene", F.md5("cds").alias("digest"), "protein")


@query(
    f"""WITH {DNA}, w AS (SELECT doc_id, 1 AS l, least(length(d), length(d) - length(d) // 4 + 50) AS r, d FROM dna WHERE length(d) >= 12), p AS (SELECT doc_id, count(*) AS n_pairs FROM labels GROUP BY doc_id)
SELECT 'd' || doc_id AS gene, n_pairs, l, r, CASE WHEN doc_id % 2 = 0 THEN '+' ELSE '-' END AS strand, CAST(doc_id AS varchar) AS seqid, md5(CASE WHEN doc_id % 2 = 0 THEN d[l:r] ELSE reverse(translate(d[l:r], 'ACGT', 'TGCA')) END) AS digest FROM w JOIN p USING (doc_id)"""
)
def region_sequences(spark, sf_dir):
    """Windows around genes that have pairs (here: labelled documents), cut out and brought to the gene's strand."""
    genome = adapter.dna(spark, sf_dir)
    named = genome.withColumn("id", F.col("id").cast("string"))
    lengths = named.select(F.col("id").alias("seqid"), F.length("seq").alias("length"))
    regions = genes.windows(genes.extents(adapter.sequence_genes(genome)), lengths, margin=50)
    pairs = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.concat(F.lit("d"), F.col("doc_id")).alias("gene"))
    found = genes.region_sequences(regions, pairs, named)
    return found.select("gene", "n_pairs", F.col("left").cast("int").alias("l"), F.col("right").cast("long").alias("r"), "strand", "seqid", F.md5("seq").alias("digest"))


# every line of documents' texts as a line of FASTA files, see adapter.fasta_rows
FASTA_ROWS = """SELECT doc_id // 1000 AS file, doc_id, p, CASE WHEN p = 0 THEN '>' ELSE translate(x, 'EFIJLOPQUXZefijlopquxz>', 'ACGTACGTACGacgtacgtacg') END AS value FROM
  (SELECT doc_id, unnest(range(len(t))) AS p, unnest(t) AS x FROM (SELECT doc_id, list_concat(CASE WHEN doc_id % 2 = 0 THEN ['>'] ELSE [NULL] END, string_split(text, chr(10))) AS t FROM documents)) WHERE x IS NOT NULL
  UNION ALL SELECT DISTINCT doc_id // 1000, doc_id // 1000 * 1000, -1, '>' FROM documents WHERE text IS NOT NULL"""


@query(
    f"""WITH l AS ({FASTA_ROWS}), s AS (SELECT *, max(CASE WHEN p <= 0 THEN doc_id * 2 + p + 1 END) OVER (PARTITION BY file ORDER BY doc_id, p) AS record FROM l),
r AS (SELECT CASE WHEN record % 2 = 1 THEN 'r' || record // 2 ELSE 'f' || file END AS id, string_agg(translate(regexp_replace(translate(value, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '[^A-Z]', '', 'g'), 'RYKMSWBDHV', 'NNNNNNNNNN'), '' ORDER BY doc_id, p) AS seq FROM s WHERE p > 0 GROUP BY file, record),
c AS (SELECT id AS seqid, seq, unnest(range((length(seq) + 999) // 1000)) AS chunk FROM r WHERE length(seq) > 0)
SELECT seqid, CAST(chunk AS int) AS chunk, md5(seq[chunk * 1000 + 1:chunk * 1000 + 1000]) AS digest FROM c"""
)
def sequence_pieces(spark, sf_dir):
    """Sequences cut into pieces of 1,000 bases straight from the lines of files, over the borders of blocks."""
    parts = sequences.sequence_pieces(adapter.fasta_rows(spark, sf_dir), size=1000)
    return parts.select("seqid", "chunk", F.md5(F.col("part").cast("binary")).alias("digest"))


@query(f"WITH {PAIRS}, {TOP} SELECT * FROM top")
def first_pairs(spark, sf_dir):
    return hints.first_pairs(ordered_pairs(spark, sf_dir))


WORDS = "SELECT DISTINCT id, d[i:i + 11] AS word FROM (SELECT id, d, unnest(range(1, length(d) - 10)) AS i FROM {t} WHERE length(d) >= 12)"


@query(
    f"""WITH q AS (SELECT item_id AS id, {BASES} AS d FROM benchmark), t AS (SELECT doc_id AS id, {BASES} AS d FROM documents), a AS ({WORDS.format(t='q')}), b AS ({WORDS.format(t='t')}),
x AS (SELECT a.id AS gene, b.id AS prot, count(*) AS score FROM a JOIN b USING (word) GROUP BY ALL HAVING count(*) >= 20)
SELECT CAST(gene AS varchar) AS gene, CAST(prot AS varchar) AS prot, score, CAST(r AS int) AS ordinal FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY score DESC, CAST(prot AS varchar)) AS r FROM x) WHERE r <= 25"""
)
def kmer_search(spark, sf_dir):
    """The engine's own approximate homology search: benchmark items as seeds, documents as targets."""
    seeds, targets = (adapter.dna(spark, sf_dir, *t).withColumn("id", F.col("id").cast("string")) for t in (("benchmark", "item_id"), ("documents", "doc_id")))
    return search.kmer_pairs(seeds, targets, k=12, best=25, least=20)


LETTERS = "regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '[^A-Z]', '', 'g')"
PLACES = "SELECT id, d[i:i + 11] AS word, i FROM (SELECT id, d, unnest(range(1, length(d) - 10)) AS i FROM {t} WHERE length(d) >= 12)"
GROUPED = "translate({x}, '" + "".join(search.ALIKE) + "', '" + "".join(str(i) * len(g) for i, g in enumerate(search.ALIKE)) + "')"
HOMOLOGY_SCORING = search.Scoring()


@query(
    f"""WITH q AS (SELECT CAST(item_id AS varchar) AS id, {LETTERS} AS d FROM benchmark), t AS (SELECT CAST(doc_id AS varchar) AS id, {LETTERS} AS d FROM documents), a AS ({PLACES.format(t='q')}), b AS ({PLACES.format(t='t')}),
n AS (SELECT sum(length(d)) AS letters FROM t),
g AS (SELECT DISTINCT a.id AS gene, b.id AS prot, CAST(b.i - a.i AS int) AS diagonal FROM a JOIN b USING (word)),
l AS (SELECT gene, prot, diagonal, q.d AS x, t.d AS y, unnest(range(greatest(1, 1 - diagonal), least(length(q.d), length(t.d) - diagonal) + 1)) AS i FROM g JOIN q ON q.id = gene JOIN t ON t.id = prot),
p AS (SELECT gene, prot, diagonal, i, length(x) AS m, CASE WHEN {GROUPED.format(x='x[i]')} NOT BETWEEN '0' AND '9' OR {GROUPED.format(x='y[i + diagonal]')} NOT BETWEEN '0' AND '9' THEN -3 WHEN x[i] = y[i + diagonal] THEN 5 WHEN {GROUPED.format(x='x[i]')} = {GROUPED.format(x='y[i + diagonal]')} THEN 1 ELSE -3 END AS v FROM l),
c AS (SELECT *, sum(v) OVER (PARTITION BY gene, prot, diagonal ORDER BY i) AS c FROM p),
w AS (SELECT *, c - min(c - v) OVER (PARTITION BY gene, prot, diagonal ORDER BY i) AS run FROM c),
k AS (SELECT gene, prot, diagonal, i, m, run, row_number() OVER (PARTITION BY gene, prot ORDER BY run DESC, diagonal, i) AS r FROM w),
e AS (SELECT gene, prot, CAST(run AS bigint) AS score, diagonal, CAST(i AS int) AS seed_end FROM k, n WHERE r = 1 AND {HOMOLOGY_SCORING.factor}::double * m * letters * exp({-HOMOLOGY_SCORING.scale!r}::double * run) <= 0.001)
SELECT gene, prot, score, diagonal, seed_end, CAST(r AS int) AS ordinal FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY score DESC, prot) AS r FROM e) WHERE r <= 25"""
)
def homology_search(spark, sf_dir):
    """Seed and extend: benchmark items as seeds, documents as proteins, runs of an e-value of 0.001 or less."""
    found = search.scored_pairs(adapter.proteins(spark, sf_dir, "benchmark", "item_id"), adapter.proteins(spark, sf_dir, "documents", "doc_id"), k=12, best=25, scoring=HOMOLOGY_SCORING)
    return found.select("gene", "prot", "score", "diagonal", "seed_end", "ordinal")


@query(
    f"""WITH {PAIRS}, re AS (SELECT 'g' || CAST(l_orderkey % 500 AS varchar) AS gene, sum(CAST(l_quantity AS bigint) * CASE WHEN l_orderkey % 500 < 50 THEN 200 ELSE 20 END)::bigint AS n FROM lineitem GROUP BY 1),
pr AS (SELECT 'p' || CAST(l_suppkey AS varchar) AS prot, sum(CAST(l_quantity AS bigint))::bigint AS n FROM lineitem GROUP BY 1),
c AS (SELECT gene, prot, re.n * pr.n AS cost, CASE WHEN re.n > 30000 OR pr.n > 15000 THEN 'long' ELSE 'usual' END AS mode, md5(gene)[1:3] AS b FROM pairs JOIN re USING (gene) JOIN pr USING (prot))
SELECT gene, prot, cost, mode, CAST(least(99, (sum(cost) OVER (ORDER BY b, gene, prot) - cost)::hugeint * 100 // sum(cost) OVER ()) AS int) AS task FROM c"""
)
def alignment_batches(spark, sf_dir):
    """All pairs in a hundred tasks of equal cost, with the aligner's mode."""
    return search.dealt_by_cost(adapter.ranked_pairs(spark, sf_dir), *adapter.aligned_lengths(spark, sf_dir), tasks=100)


TEXT = """CAST(l_orderkey AS bigint) * 8 + l_linenumber AS ordinal, 'chr' || CAST(l_suppkey % 5 AS varchar) AS seqid, CASE l_linenumber % 4 WHEN 0 THEN 'CDS' WHEN 1 THEN 'Intron' WHEN 2 THEN 'start_codon' ELSE 'stop_codon' END AS type, l_partkey * 30 + 1 AS s, l_partkey * 30 + 90 AS e,
  CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, CAST(l_suppkey % 3 AS varchar) AS phase, 'p' || CAST(l_suppkey AS varchar) AS prot, 'g' || CAST(l_orderkey % 500 AS varchar) AS gene, CAST(l_quantity AS int) AS n"""


@query(f"WITH t AS (SELECT {TEXT}, l_quantity FROM lineitem WHERE l_linenumber <> 7) SELECT ordinal, seqid, type, s, e, CASE WHEN n % 2 = 0 THEN n END AS score, strand, phase, prot, gene, n / 64.0::double AS al, n % 5 = 0 AS top FROM t")
def gff_scan(spark, sf_dir):
    """Lines of nine columns, some malformed or comments, read as typed hints."""
    found = parsed_hints(adapter.hint_text(spark, sf_dir))
    return short(found.select("ordinal", "seqid", "type", "start", "end", "score", "strand", "phase", "prot", "gene", "al_score", "top"))


@query("SELECT CAST(l_orderkey AS bigint) * 8 + l_linenumber AS ordinal FROM lineitem WHERE l_linenumber = 7 AND l_orderkey % 2 = 0")
def malformed_lines(spark, sf_dir):
    """Lines that are neither features nor comments."""
    return features_malformed(adapter.hint_text(spark, sf_dir)).select("ordinal")


@query(f"WITH t AS (SELECT {TEXT} FROM lineitem WHERE l_linenumber <> 7) SELECT ordinal, seqid, type, s, e, strand, phase, gene, gene || '_' || prot AS tx FROM t")
def gtf_scan(spark, sf_dir):
    """Seed genes from lines with quoted attributes."""
    return short(parsed_genes(adapter.gene_text(spark, sf_dir), strict=True))


@query(f"""WITH {DNA}, m AS (SELECT doc_id, translate(regexp_replace(translate(translate(text, 'atcg', 'NNNN'), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '[^A-Z]', '', 'g'), 'RYKMSWBDHV', 'NNNNNNNNNN') AS m FROM documents) SELECT doc_id, md5(m) AS digest, length(m) AS n FROM m""")
def soft_mask(spark, sf_dir):
    """Lower-case bases count as N, letters for several bases too."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", clean_dna(F.col("text"), mask_lower=True).alias("m")).select("doc_id", F.md5("m").alias("digest"), F.length("m").cast("long").alias("n"))


@query(f"WITH {DNA} SELECT '>' || doc_id || chr(10) || d || chr(10) AS value FROM dna WHERE length(d) > 600")
def fasta_text(spark, sf_dir):
    """Sequences of more than 600 letters as records."""
    return fasta_lines(adapter.dna(spark, sf_dir).withColumn("id", F.col("id").cast("string")), least=600)


@query(
    f"""WITH {DNA}, x AS (SELECT doc_id, d, length(d) AS n, doc_id % 40 AS sc, doc_id % 3 AS ps, doc_id % 7 AS pe FROM dna WHERE length(d) >= 30),
e AS (SELECT doc_id, d, 1 AS ps, 1 + doc_id % 11 AS s, 12 AS e, sc, 5 AS pe, 1 AS o FROM x UNION ALL SELECT doc_id, d, 6 + ps, 15, 20 + doc_id % 9, sc, 10 + pe, 2 FROM x)
SELECT 'p' || doc_id AS prot, 'd' || doc_id AS gene, 'start_codon' AS type, s, s + 2 AS e FROM e WHERE o = 1 AND sc > 25 AND d[s:s + 2] = 'ATG'
UNION ALL SELECT 'p' || doc_id, 'd' || doc_id, 'stop_codon', e + 1, e + 3 FROM e WHERE o = 2 AND sc > 25 AND 18 - pe < 5 AND d[e + 1:e + 3] IN ('TAA', 'TAG', 'TGA')"""
)
def terminal_codons(spark, sf_dir):
    """Start and stop codons at the ends of alignments of two exons."""
    some = adapter.dna(spark, sf_dir).where(F.length("seq") >= 30)
    return short(exons.terminal_codons(adapter.two_exons(some), some.select(F.concat(F.lit("d"), "id").alias("gene"), "seq"), some.select(F.concat(F.lit("p"), "id").alias("prot"), F.lit(18).alias("length"))))


@query(f"WITH {PAIRS}, o AS (SELECT gene, prot, row_number() OVER (ORDER BY sc DESC, gene, prot) AS ordinal FROM pairs), r AS (SELECT *, lag(gene) OVER (ORDER BY ordinal) AS before FROM o) SELECT gene, prot, CAST(ordinal AS bigint) AS ordinal FROM r WHERE before IS DISTINCT FROM gene")
def run_starts(spark, sf_dir):
    """The first pair of each run of one gene in a list whose genes don't lie together."""
    return hints.run_starts(hints.listed(adapter.ranked_pairs(spark, sf_dir), F.desc("score"), "gene", "prot").drop("score"))


@query(
    f"""WITH {gtf_sql('gn', 6)}, {gtf_sql('go', 7)}, {", ".join(f"l{k} AS (SELECT gene, tx FROM (SELECT gene, tx, row_number() OVER (PARTITION BY gene ORDER BY sum(e - s) DESC, min(ln), tx) AS r FROM {k} GROUP BY gene, tx HAVING sum(e - s) > 0) WHERE r = 1), k{k} AS (SELECT * FROM {k} SEMI JOIN l{k} USING (gene, tx))" for k in ("gn", "go"))},
{SIGNATURES.replace('FROM gn', 'FROM kgn').replace('FROM go', 'FROM kgo')}, {SAME}
SELECT seqid, s, e, strand, gene, 'fresh' AS origin FROM kgn WHERE gene IN (SELECT gene FROM sn WHERE sig NOT IN (SELECT sig FROM so)) UNION ALL SELECT seqid, s, e, strand, same.gene, 'reused' FROM go JOIN same ON go.gene = same.old"""
)
def iter_union(spark, sf_dir):
    """Hints of changed genes made anew, those of unchanged ones taken over under their new names. Here a gene's segments are its hints."""
    new, old = adapter.genes(spark, sf_dir, 6), adapter.genes(spark, sf_dir, 7)
    fresh = lambda seeds: seeds.withColumn("origin", F.lit("fresh"))
    _, both = standard.next_iteration(new, old, old.withColumn("origin", F.lit("reused")), fresh)
    return short(both.select("seqid", "start", "end", "strand", "gene", "origin"))


@query(
    f"""WITH {H}, {PAIRS}, {TOP}, f AS (SELECT h.* FROM h SEMI JOIN pairs USING (gene, prot)), t AS (SELECT f.* FROM f SEMI JOIN top USING (gene, prot)),
{COMB.split('FROM lineitem), ')[1].replace('FROM h', 'FROM f')}, {CHAINS.format(more='').replace('FROM h', 'FROM t')},
{SUPPORT.split('GROUP BY seqid, type, s, e, strand), ')[1]}, sup AS (SELECT * FROM comb WHERE type = 'CDS' AND CASE WHEN strand = '+' THEN s - 1 IN (SELECT p FROM ie) OR s IN (SELECT p FROM st) ELSE e + 1 IN (SELECT p FROM ie) OR e IN (SELECT p FROM st) END),
ov AS ({OVERLAP.format(starts='comb', cds='sup')}), al AS (SELECT seqid, type, s, e, strand, score, al, ss, 0 AS cds_overlap FROM comb WHERE type IN ('Intron', 'stop_codon') UNION ALL SELECT * FROM ov),
c AS (SELECT a.*, CAST(CASE WHEN -4.00529 + 4.73909 * (score / m) + 9.09026 * al >= 0.85 THEN 2 ELSE 0 END AS int) AS class FROM al a, (SELECT median(score) AS m FROM al))
SELECT seqid, {KIND}, s, e, strand, 'P' AS src, score AS mult, class, NULL AS grp FROM c
UNION ALL SELECT seqid, {KIND}, s, e, strand, 'M', score, NULL, NULL FROM al WHERE {HC} AND cds_overlap <= 0
UNION ALL SELECT seqid, {KIND}, s, e, strand, 'C', 1, NULL, prot || '_' || gene FROM ch"""
)
def standard_export(spark, sf_dir):
    """The whole run from raw hints and pairs to the export: top flags, combining, support, overlap, classes, filter, chains."""
    out = standard.standard_run(adapter.raw_hints(spark, sf_dir), ordered_pairs(spark, sf_dir))
    return short(out.export.select("seqid", "type", "start", "end", "strand", "src", "mult", "class", "grp"))


def as_text(lines: DataFrame, name: str) -> str:
    """The folder of a text file of lines(value), in the folder that driver and executors share."""
    path = combined.state_path(lines.sparkSession, name)
    lines.write.text(path)
    return path


@query(f"WITH {PAIRS} SELECT gene, prot FROM pairs WHERE sc % 3 > 0")
def pair_list(spark, sf_dir):
    """Pairs read from text of several forms, with comments and empty lines between them."""
    p = adapter.ranked_pairs(spark, sf_dir)
    line = F.when(F.col("score") % 3 == 0, F.when(F.col("score") % 2 == 0, F.concat(F.lit("# "), "gene")).otherwise("  ")).when(F.col("score") % 2 == 0, F.concat_ws("\t", "gene", "prot", "score")).otherwise(F.concat(F.lit(" "), "gene", F.lit("  "), "prot"))
    return sequences.read_pairs(spark, as_text(p.select(line.alias("value")), "pairs")).select("gene", "prot")


@query(f"WITH {DNA} SELECT doc_id::varchar AS id, md5(d) AS digest FROM dna WHERE length(d) > 0 AND doc_id IN (SELECT l_suppkey FROM lineitem)")
def fasta_by_ids(spark, sf_dir):
    """Sequences of a FASTA file whose ids another table names."""
    path = as_text(fasta_lines(adapter.dna(spark, sf_dir).withColumn("id", F.col("id").cast("string"))), "fasta")
    ids = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_suppkey").cast("string").alias("id"))
    return sequences.read_fasta(spark, path, ids).select("id", F.md5("seq").alias("digest"))


@query(f"WITH {COMB} SELECT seqid, type, s, e, strand, score, ss, row_number() OVER (ORDER BY seqid, s, e, type, strand) AS place FROM comb")
def sorted_file(spark, sf_dir):
    """Combined hints written in order of their places and read again: the file's order is that order."""
    path = combined.state_path(spark, "sorted")
    rows = comb(spark, sf_dir).withColumns({"prot": F.lit(None).cast("string"), "gene": F.lit(None).cast("string")})
    write_hints(rows, path)
    read = read_hints(spark, path)
    # places follow from how many rows come before: by sequence, then within it in the file's order
    before = read.groupBy("seqid").agg(F.count("*").alias("n"))
    base = before.alias("a").join(before.alias("b"), F.expr("b.seqid < a.seqid"), "left").groupBy("a.seqid").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("base"))
    w = Window.partitionBy("seqid").orderBy("ordinal")
    placed = read.join(base, "seqid").withColumn("place", F.row_number().over(w) + F.col("base"))
    return short(placed.select("seqid", "type", "start", "end", "strand", F.col("score").cast("long"), "splice_sites", "place"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
