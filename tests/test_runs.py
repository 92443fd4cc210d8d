"""Whole runs on hand-made genomes: from seeds to hints, from files, and of a second iteration."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hintforge.config import Cutoffs, EngineConfig
from hintforge.operators import genes
from hintforge.plans import standard
from hintforge.sources import features, sequences

rng = random.Random(5)
COMPLEMENT = str.maketrans("ACGT", "TGCA")


def strand_of(text, strand):
    return text if strand == "+" else text[::-1].translate(COMPLEMENT)


def world(tmp_path):
    """A genome of two sequences, three genes of two segments, and a protein for each gene but one."""
    genome = {"c1": "".join(rng.choice("ACGT") for _ in range(900)), "c2": "".join(rng.choice("ACGT") for _ in range(500))}
    rows = [("c1", 101, 160, "+", "0", "a"), ("c1", 201, 260, "+", "0", "a"), ("c1", 501, 590, "-", "0", "b"), ("c1", 641, 700, "-", "0", "b"), ("c2", 61, 120, "+", "0", "c"), ("c2", 151, 210, "+", "0", "c")]
    gtf = "".join(f'{q}\tx\tCDS\t{s}\t{e}\t.\t{d}\t{p}\tgene_id "{g}"; transcript_id "{g}1";\n' for q, s, e, d, p, g in rows)
    (tmp_path / "genome.fa").write_text("".join(f">{k} note\n{v[:70]}\n{v[70:].lower()}\n" for k, v in genome.items()))
    (tmp_path / "seeds.gtf").write_text("# seeds\n" + gtf)
    return genome, rows


def proteins_of(spark, tmp_path):
    seeds, genome = features.read_genes(spark, str(tmp_path / "seeds.gtf"), strict=True), sequences.read_genome(spark, str(tmp_path / "genome.fa"))
    made = {r.gene: r.protein for r in genes.coding_sequences(seeds, genome).collect()}
    (tmp_path / "proteins.fa").write_text("".join(f">p{g}\n{p}\n" for g, p in sorted(made.items()) if g != "c") + ">other\nMMMMMMMMMM\n")
    return made


def aligner(batch: pd.DataFrame) -> pd.DataFrame:
    """An intron at places 11 to 40 of the region, and a segment before it that tells how long the region is."""
    out = []
    for r in batch.itertuples():
        out.append((r.gene, r.prot, "Intron", 11, 40, "+", 0.5, "gt_ag"))
        out.append((r.gene, r.prot, "CDS", 1, len(r.region), "+", None, None))
    return pd.DataFrame(out, columns=["gene", "prot", "type", "start", "end", "strand", "al_score", "splice_sites"])


def test_from_seeds_to_hints(spark, tmp_path):
    genome, rows = world(tmp_path)
    made = proteins_of(spark, tmp_path)
    for g in "abc":
        parts = [(s, e, d, q) for q, s, e, d, _, x in rows if x == g]
        spliced = strand_of("".join(genome[parts[0][3]][s - 1 : e] for s, e, *_ in parts), parts[0][2])
        assert len(made[g]) == len(spliced) // 3
    config = EngineConfig(seeds=str(tmp_path / "seeds.gtf"), window=20, word=4, cutoffs=Cutoffs(intron_coverage=1))
    out = standard.full_run(spark, str(tmp_path / "genome.fa"), str(tmp_path / "proteins.fa"), aligner, config)
    got = {(r.seqid, r.start, r.end, r.strand, r.top) for r in out.combined.where("type = 'Intron'").collect()}
    # windows begin 20 places before a; b's counts from its right end
    assert got == {("c1", 81 + 10, 81 + 39, "+", True), ("c1", 720 - 39, 720 - 10, "-", True)}
    assert {(r.start, r.end) for r in out.evidence.collect()} == {(s, e) for _, s, e, *_ in got}
    assert {r.src for r in out.export.collect()} == {"P", "M", "C"}


def test_second_iteration_aligns_only_what_changed(spark, tmp_path):
    world(tmp_path)
    proteins_of(spark, tmp_path)
    config = EngineConfig(seeds=str(tmp_path / "seeds.gtf"), window=20, word=4)
    paths = (str(tmp_path / "genome.fa"), str(tmp_path / "proteins.fa"))
    seeds, genome = features.read_genes(spark, config.seeds), sequences.read_genome(spark, paths[0])
    raw, pairs = standard.lifted_hints(seeds, genome, sequences.read_fasta(spark, paths[1]), aligner, config)
    old = "".join(f"{r.seqid}\tx\t{r.type}\t{r.start}\t{r.end}\t.\t{r.strand}\t.\tprot={r.prot}; seed_gene_id={r.gene};" + (f" al_score={r.al_score}; splice_sites={r.splice_sites};" if r.type == "Intron" else "") + " topProt=TRUE;\n" for r in raw.collect())
    (tmp_path / "old.gff").write_text(old)
    text = (tmp_path / "seeds.gtf").read_text()
    (tmp_path / "old.gtf").write_text(text)
    (tmp_path / "new.gtf").write_text(text.replace("\t501\t", "\t504\t").replace('"a', '"renamed'))
    config = EngineConfig(seeds=str(tmp_path / "new.gtf"), previous_seeds=str(tmp_path / "old.gtf"), previous_alignments=str(tmp_path / "old.gff"), window=20, word=4)
    out = standard.full_run(spark, *paths, aligner, config)
    got = {(r.seqid, r.start, r.end, r.strand) for r in out.combined.where("type = 'Intron'").collect()}
    assert got == {("c1", 91, 120, "+"), ("c1", 681, 710, "-")}
    assert {r.grp for r in out.export.where("src = 'C'").collect()} == {"pa_renamed", "pb_b"}


def test_alignments_made_elsewhere(spark, tmp_path):
    world(tmp_path)
    proteins_of(spark, tmp_path)
    (tmp_path / "raw.gff").write_text("c1\tx\tIntron\t161\t200\t.\t+\t.\tprot=pa; seed_gene_id=a; al_score=0.4; splice_sites=GT_AG;\n" * 4)
    (tmp_path / "pairs.txt").write_text("a\tpa\na\tpb\n")
    config = EngineConfig(seeds=str(tmp_path / "seeds.gtf"), pairs=str(tmp_path / "pairs.txt"), alignments=str(tmp_path / "raw.gff"))
    out = standard.full_run(spark, str(tmp_path / "genome.fa"), str(tmp_path / "proteins.fa"), aligner, config)
    assert [(r.start, r.end, r.score) for r in out.evidence.collect()] == [(161, 200, 4)]
    (tmp_path / "pairs.txt").write_text("a\tpb\na\tpa\n")
    with pytest.raises(ValueError, match="first protein"):
        standard.full_run(spark, str(tmp_path / "genome.fa"), str(tmp_path / "proteins.fa"), aligner, config)


def test_chunks_give_what_whole_sequences_give(spark):
    text = "".join(rng.choice("ACGT") for _ in range(1000))
    genome = spark.createDataFrame([("s", text), ("t", "ACGTACGT"), ("empty", ""), ("none", None)], "id string, seq string")
    spans = [(i, rng.choice(["s", "t", "empty", "gone"]), a, a + rng.randint(-1, 400)) for i, a in enumerate(rng.randint(-5, 1005) for _ in range(120))]
    got = {r.k: r.seq for r in genes.cut_out(spark.createDataFrame(spans, "k int, seqid string, left long, right long"), genome, ["k"], 64).collect()}
    whole = {"s": text, "t": "ACGTACGT"}
    want = {k: whole.get(q, "")[max(a, 1) - 1 : max(b, 0)] for k, q, a, b in spans}
    assert got == {k: v for k, v in want.items() if v}


def test_faulty_inputs(spark, tmp_path):
    (tmp_path / "bad.fa").write_text("ACGT\n>c\nAC\n")
    with pytest.raises(Exception, match="before the first header"):
        sequences.read_fasta(spark, str(tmp_path / "bad.fa")).collect()
    (tmp_path / "good.fa").write_text("\n>c one\nAC\nGT\n>d\n\n>e\nA\n")
    assert [(r.id, r.seq) for r in sequences.read_fasta(spark, str(tmp_path / "good.fa")).orderBy("id").collect()] == [("c", "ACGT"), ("d", ""), ("e", "A")]
    (tmp_path / "bad.gtf").write_text('c\tx\tCDS\t1\t9\t.\t+\t0\tgene_id "a"; transcript_id "a";\nc\tx\tCDS\tone\t9\t.\t+\t0\tgene_id "a";\n')
    assert features.read_genes(spark, str(tmp_path / "bad.gtf")).count() == 1
    with pytest.raises(Exception, match="not a feature"):
        features.read_genes(spark, str(tmp_path / "bad.gtf"), strict=True).collect()
    for wrong in ({"previous_seeds": "x"}, {"pairs": "x"}, {"chain_cut": 4}, {"chain_cut": -3}, {"max_proteins_per_seed": 0}, {"window": -1}, {"seeds": "s", "alignments": "a", "previous_seeds": "p", "previous_alignments": "q"}):
        with pytest.raises(ValueError):
            EngineConfig(**wrong)
    with pytest.raises(ValueError, match="no pairs"):
        standard.check_inputs(spark.createDataFrame([], "gene string, prot string, ordinal long"), spark.range(1).select(F.lit("g").alias("gene"), F.lit("p").alias("prot")))
