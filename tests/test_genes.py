"""Genes, sequences, search plug-ins and increments on hand-made rows."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hintforge.functions import sequence
from hintforge.operators import genes, search
from hintforge.plans import standard
from hintforge.sources import features, sequences
from hintforge.streaming import increments


def gtf(*rows):
    return "".join(f'{s}\tx\t{t}\t{a}\t{b}\t.\t{st}\t{ph}\tgene_id "{g}"; transcript_id "{tx}";\n' for s, t, a, b, st, ph, g, tx in rows)


def read(spark, tmp_path, text, name="g.gtf"):
    (tmp_path / name).write_text(text)
    return features.read_genes(spark, str(tmp_path / name))


def test_longest_isoform(spark, tmp_path):
    g = read(spark, tmp_path, gtf(("c", "CDS", 1, 10, "+", 0, "a", "a1"), ("c", "CDS", 1, 11, "+", 0, "a", "a2"), ("c", "exon", 1, 50, "+", ".", "a", "a2"), ("c", "CDS", 5, 15, "+", 0, "a", "a3"), ("c", "CDS", 7, 7, "+", 0, "b", "b1")) + "# end\n\n")
    kept = genes.keep_longest(g).collect()
    assert {(r.tx, r.type) for r in kept} == {("a2", "CDS"), ("a2", "exon")}


def test_faults(spark, tmp_path):
    g = read(spark, tmp_path, gtf(("c", "CDS", 1, 10, "+", 0, "ok", "t"), ("c", "CDS", 1, 10, "+", 0, "s", "t"), ("c", "CDS", 1, 10, "-", 0, "s", "t"), ("c", "start_codon", 1, 3, "+", 0, "u", "t"), ("c", "start_codon", 4, 6, "+", 0, "u", "t")))
    assert {r.gene for r in features.gene_faults(g).collect()} == {"s", "u"}
    with pytest.raises(ValueError, match="faulty"):
        features.checked(g)


def test_extents_and_windows(spark, tmp_path):
    g = read(spark, tmp_path, gtf(("c", "CDS", 300, 310, "-", 0, "a", "t"), ("c", "CDS", 100, 200, "-", 0, "a", "t"), ("c", "start_codon", 308, 310, "-", 0, "a", "t")))
    e = genes.extents(g).first()
    assert (e.left, e.right, e.start_codon, e.stop_codon, e.strand) == (100, 310, 308, -1, "-")
    lengths = spark.createDataFrame([("c", 400)], "seqid string, length long")
    w = genes.windows(genes.extents(g), lengths, 150).first()
    assert (w.left, w.right) == (1, 400) and genes.windows(genes.extents(g), lengths, max_gene=210).count() == 0


def test_region_and_coding_sequences(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">c first\nacgtA\nCGTNNry\n>d\nATGAAATGA\nCC\n")
    genome = sequences.read_genome(spark, str(tmp_path / "g.fa"))
    assert {r.id: r.seq for r in genome.collect()} == {"c": "ACGTACGTNNNN", "d": "ATGAAATGACC"}
    assert {r.id: r.seq for r in sequences.read_genome(spark, str(tmp_path / "g.fa"), mask_lower=True).collect()}["c"] == "NNNNACGTNNRY".replace("RY", "NN")
    regions = spark.createDataFrame([("g1", 2, 5, "+", "c"), ("g2", 2, 5, "-", "c"), ("g3", 1, 2, "+", "c")], "gene string, left long, right long, strand string, seqid string")
    pairs = spark.createDataFrame([("g1", "p"), ("g1", "q"), ("g2", "p")], "gene string, prot string")
    assert {(r.gene, r.n_pairs, r.seq) for r in genes.region_sequences(regions, pairs, genome).collect()} == {("g1", 2, "CGTA"), ("g2", 1, "TACG")}
    g = read(spark, tmp_path, gtf(("d", "CDS", 5, 11, "+", 1, "p", "t"), ("d", "CDS", 1, 4, "+", 0, "p", "t"), ("d", "CDS", 1, 8, "-", 1, "m", "t"), ("d", "CDS", 2, 11, "+", 2, "f", "t"), ("d", "CDS", 1, 3, "+", ".", "n", "t")))
    got = {r.gene: (r.cds, r.protein) for r in genes.coding_sequences(g, genome).collect()}
    assert got == {"p": ("ATGAAATGA", "MK"), "m": ("ATTTCA", "IS"), "f": ("AAATGA", "K"), "n": ("ATG", "M")}


def test_bad_dna_is_an_error(spark, tmp_path):
    (tmp_path / "bad.fa").write_text(">c\nACGTE\n")
    with pytest.raises(Exception, match="not DNA"):
        sequences.read_genome(spark, str(tmp_path / "bad.fa")).collect()


def test_sequence_functions(spark):
    df = spark.createDataFrame([("",), ("A",), ("ATGTAATAG",), ("ATGNNNTAG",), ("TAATAA",)], "s string")
    assert [r[0] for r in df.select(sequence.translate(F.col("s"))).collect()] == ["", "", "M*", "MX", "*"]
    lines = spark.createDataFrame([("a.b.c|d|",), (".x",), ("none",)], "s string")
    assert [r[0] for r in lines.select(sequence.clean_protein_line(F.col("s"))).collect()] == ["ab.c_d_", "x", "none"]


def test_fasta_ids_and_sink(spark, tmp_path):
    (tmp_path / "p.fa").write_text(">p1 x\nMK*\n>p2\nML\nLL\n>p3\n\n")
    only = spark.createDataFrame([("p2",), ("p9",)], "id string")
    assert [(r.id, r.seq) for r in sequences.read_fasta(spark, str(tmp_path / "p.fa"), only).collect()] == [("p2", "MLLL")]
    everything = sequences.read_fasta(spark, str(tmp_path / "p.fa"))
    assert sorted(r.value for r in sequences.fasta_lines(everything).collect()) == [">p1\nMK*\n", ">p2\nMLLL\n"]
    sequences.write_fasta(everything, str(tmp_path / "out"), least=3)
    assert {r.seq for r in sequences.read_fasta(spark, str(tmp_path / "out")).collect()} == {"MLLL"}


def test_pairs_and_exon_tables(spark, tmp_path):
    (tmp_path / "pairs").write_text("# c\n\ng1 p1 9\ng1\tp2\n")
    assert [(r.gene, r.prot) for r in sequences.read_pairs(spark, str(tmp_path / "pairs")).orderBy("ordinal").collect()] == [("g1", "p1"), ("g1", "p2")]
    (tmp_path / "bad").write_text("g1\n")
    with pytest.raises(Exception, match="not a pair"):
        sequences.read_pairs(spark, str(tmp_path / "bad")).collect()
    (tmp_path / "exons").write_text("# x\np\tg\t99\t20\t0\t0\t1\t20\t100\t160\t33.5\t0\t7\t1\ta b c d e GT.AG\n@ y\n")
    r = sequences.read_exons(spark, str(tmp_path / "exons")).first()
    assert (r.prot, r.gene, r.prot_start, r.start, r.end, r.exon_score, r.splice_sites) == ("p", "g", 1, 100, 160, 33.5, "GT.AG")


def seeds(spark, tmp_path, name, genes_at):
    return read(spark, tmp_path, gtf(*((("c", "CDS", a, a + 20, "+", 0, g, f"t{g}")) for g, a in genes_at)), name)


def test_next_iteration(spark, tmp_path):
    old = seeds(spark, tmp_path, "old", [("o1", 1), ("o2", 100), ("o3", 100)])
    new = seeds(spark, tmp_path, "new", [("n1", 1), ("n2", 100), ("n3", 100), ("n4", 500)])
    kept = spark.createDataFrame([("o1", 7, True), ("o3", 8, False), ("o2", 9, False)], "gene string, start long, top boolean")
    fresh = lambda unique: unique.selectExpr("gene", "start", "true AS top")
    unique, raw = standard.next_iteration(new, old, kept, fresh)
    assert {r.gene for r in unique.collect()} == {"n4"}
    # equal old genes: the last one's hints stay; equal new genes: the last name stands
    assert {tuple(r) for r in raw.collect()} == {("n4", 500, True), ("n1", 7, True), ("n3", 8, False)}


def test_kmer_search(spark):
    seeds_ = spark.createDataFrame([("g", "MKLVPQRSTW"), ("h", "AAA")], "id string, seq string")
    prots = spark.createDataFrame([("p", "XXMKLVPQRXX"), ("q", "MKLVPXXXXX"), ("r", "WWWWWWWW"), ("s", "MKLVPQRSTW")], "id string, seq string")
    assert [(r.prot, r.score) for r in search.kmer_pairs(seeds_, prots, 4, best=2).orderBy("ordinal").collect()] == [("s", 7), ("p", 4)]


def test_kmer_search_counts_frequent_words(spark):
    seeds_ = spark.createDataFrame([("g", "MKLVPQ"), ("h", "VPQRST")], "id string, seq string")
    prots = spark.range(10_050).selectExpr("concat('p', lpad(id, 5, '0')) AS id", "'XXMKLVPQXX' AS seq")
    got = [tuple(r) for r in search.kmer_pairs(seeds_, prots, 4, best=2).orderBy("gene", "ordinal").collect()]
    assert got == [("g", "p00000", 3, 1), ("g", "p00001", 3, 2)]
    once = search.kmer_pairs(seeds_, prots, 4, best=10_050, least=1)
    assert sorted((r.gene, r.n) for r in once.groupBy("gene").agg({"prot": "count"}).toDF("gene", "n").collect()) == [("g", 10_050)]


def test_aligner_plug_in(spark):
    pairs = spark.createDataFrame([("g", "p"), ("g", "none")], "gene string, prot string")
    regions = spark.createDataFrame([("g", "ACGT")], "gene string, seq string")
    proteins = spark.createDataFrame([("p", "MK")], "id string, seq string")

    def aligner(batch):
        return pd.DataFrame({"gene": batch.gene, "prot": batch.prot, "n": batch.region.str.len() + batch.protein.str.len()})

    assert [tuple(r) for r in search.align(pairs, regions, proteins, aligner, "gene string, prot string, n long").collect()] == [("g", "p", 6)]


def test_stream_of_seeds(spark, tmp_path):
    src, seen = tmp_path / "in", []
    src.mkdir()
    rows = lambda *at: pd.DataFrame([{"gene": g, "seqid": "c", "type": "CDS", "start": a, "end": a + 9, "strand": "+", "phase": "0", "ordinal": a} for g, a in at])
    schema = "gene string, seqid string, type string, start long, end long, strand string, phase string, ordinal long"
    for batch in (rows(("a", 1), ("b", 50)), rows(("c", 1), ("d", 90))):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(str(src))
        q = increments.watch_seeds(spark.readStream.schema(schema).parquet(str(src)), str(tmp_path / "known"), lambda df, n: seen.append({r.gene for r in df.collect()}), str(tmp_path / "cp"))
        q.awaitTermination()
    assert seen == [{"a", "b"}, {"d"}]
