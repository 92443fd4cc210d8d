"""Hint operators on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from hintforge.config import Cutoffs, EngineConfig
from hintforge.operators import exons, hints
from hintforge.plans import standard
from hintforge.sources import features

RAW = """chr1\tal\tIntron\t100\t200\t.\t+\t.\tprot=p1; splice_sites=gt_ag; al_score=0.30; seed_gene_id=g1;
chr1\tal\tIntron\t100\t200\t3\t+\t.\tprot=p2; al_score=0.3; seed_gene_id=g1; topProt=TRUE;
chr1\tal\tIntron\t100\t200\t.\t-\t.\tprot=p2; splice_sites=GC_AG; al_score=0.9; seed_gene_id=g2; fullProteinAligned=TRUE;
# a comment

chr1\tal\tstart_codon\t500\t502\t.\t+\t0\tprot=p1; al_score=0.2; seed_gene_id=g1; nextIntron=5;
chr2\tal\tstart_codon\t500\t502\t7\t+\t0\tprot=p1; seed_gene_id=g1;
chr1\tal\tCDS\t490\t520\t.\t-\t0\tprot=p1; seed_gene_id=g1;
chr1\tal\tCDS\t201\t260\t2\t+\t0\tprot=p1; seed_gene_id=g1;
chr1\tal\tCDS\t500\t520\t.\t+\t0\tprot=p1; seed_gene_id=g1;
chr1\tal\tstop_codon\t900\t902\t.\t+\t0\tprot=p1; al_score=0.005; seed_gene_id=g1;
not a feature
chr1\tal\tCDS\tx\t520\t.\t+\t0\tprot=p1;
"""


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("gff") / "raw.gff"
    path.write_text(RAW)
    assert features.malformed(spark, str(path)).count() == 2
    return features.read_hints(spark, str(path)).cache()


def test_scan(raw):
    rows = raw.orderBy("ordinal").collect()
    assert len(rows) == 9 and (rows[0].prot, rows[0].gene, rows[0].al_score, rows[0].al_text, rows[0].splice_sites, rows[0].score, rows[0].top) == ("p1", "g1", 0.3, "0.30", "gt_ag", None, False)
    assert rows[1].top and rows[1].score == 3 and rows[1].splice_sites is None and rows[2].full


def test_combine_sums_and_keeps_texts(raw):
    got = {(r.type, r.seqid, r.start, r.strand): r for r in hints.combine(raw).collect()}
    r = got["Intron", "chr1", 100, "+"]
    assert (r.score, r.al_score, r.al_text, r.splice_sites, r.top) == (4, 0.3, "0.30", "gt_ag", True) and len(got) == 8
    assert got["start_codon", "chr2", 500, "+"].al_text is None


def test_write_and_read_again(spark, raw, tmp_path):
    combined = hints.combine(raw)
    features.write_hints(combined, str(tmp_path / "out"))
    back = features.read_hints(spark, str(tmp_path / "out"))
    cols = ["seqid", "type", "start", "end", "strand", "score", "al_score", "al_text", "splice_sites", "top", "phase"]
    assert sorted(map(str, back.select(*cols).collect())) == sorted(map(str, combined.select(*(F.col("score").cast("int").alias(c) if c == "score" else c for c in cols)).collect()))


def hint(spark, **values):
    base = {"seqid": "c", "type": "Intron", "start": 1, "end": 9, "strand": "+", "score": 4, "al_score": 0.25, "splice_sites": "gt_ag", "top": False, "full": False, "cds_overlap": None}
    schema = "seqid string, type string, start long, end long, strand string, score int, al_score double, splice_sites string, top boolean, full boolean, cds_overlap int"
    return spark.createDataFrame([tuple((base | values).values())], schema)


@pytest.mark.parametrize(
    ("values", "cutoffs", "passes"),
    [
        ({}, {}, True), ({"score": 3}, {}, False), ({"al_score": 0.249}, {}, False), ({"al_score": None}, {}, False), ({"splice_sites": None}, {}, True), ({"splice_sites": "GT_AG"}, {}, True),
        ({"splice_sites": "gc_ag"}, {}, False), ({"splice_sites": "gc_ag"}, {"gc_ag": True}, True), ({"splice_sites": "at_ac"}, {"gc_ag": True}, False), ({"splice_sites": "at_ac"}, {"all_splice_sites": True}, True),
        ({"score": 1, "top": True}, {}, False), ({"score": 1, "top": True}, {"top_proteins": True}, True), ({"score": 1, "full": True}, {"full_proteins": True}, True), ({"score": None, "top": True}, {"top_proteins": True}, True),
        ({"type": "stop_codon", "al_score": None}, {}, True), ({"type": "stop_codon", "al_score": 0.009}, {}, False), ({"type": "stop_codon", "score": 1, "full": True}, {"full_proteins": True}, False), ({"type": "stop_codon", "score": 1, "top": True}, {"top_proteins": True}, True),
        ({"type": "start_codon"}, {}, True), ({"type": "start_codon", "cds_overlap": 1}, {}, False), ({"type": "start_codon", "cds_overlap": 1}, {"start_overlap": 1}, True), ({"type": "CDS", "score": 1, "al_score": None}, {}, True),
    ],
)
def test_confidence(spark, values, cutoffs, passes):
    assert hints.filter_hints(hint(spark, **values), Cutoffs(**cutoffs)).count() == passes


def test_overlap_is_strict_and_ignores_strand(raw):
    starts, cds = raw.where("type = 'start_codon'"), hints.combine(raw.where("type = 'CDS'"))
    for f in (hints.count_overlaps, hints.count_overlaps_binned):
        got = {(r.seqid, r.start): r.cds_overlap for r in f(hints.combine(starts), cds).collect()}
        assert got == {("chr1", 500): 1, ("chr2", 500): 0}
    assert {r.cds_overlap for r in hints.count_overlaps_binned(hints.combine(starts), cds, 7).collect()} == {0, 1}


def test_support_by_position_or_strict(spark):
    cds = spark.createDataFrame([("a", 201, 260, "+"), ("b", 201, 260, "+"), ("a", 40, 99, "-"), ("a", 500, 520, "+"), ("a", 30, 90, "-"), ("a", 202, 260, "+")], "seqid string, start long, end long, strand string")
    others = spark.createDataFrame([("a", "Intron", 100, 200, "+"), ("a", "Intron", 100, 300, "-"), ("z", "start_codon", 500, 502, "+"), ("a", "start_codon", 88, 90, "-"), ("a", "stop_codon", 202, 204, "+")], "seqid string, type string, start long, end long, strand string")
    loose = {(r.seqid, r.start) for r in hints.supported_cds(cds, others).collect()}
    strict = {(r.seqid, r.start) for r in hints.supported_cds(cds, others, strict=True).collect()}
    assert loose == {("a", 201), ("b", 201), ("a", 40), ("a", 500), ("a", 30)} and strict == {("a", 201), ("a", 40), ("a", 30)}


def test_flags_pairs_and_runs(spark, raw):
    pairs = spark.createDataFrame([("g1", "p2", 0), ("g1", "p1", 1), ("g2", "p2", 2), ("g1", "p3", 3)], "gene string, prot string, ordinal long")
    assert {(r.gene, r.prot) for r in hints.flag_top(raw, pairs).where("top").collect()} == {("g1", "p2"), ("g2", "p2")}
    assert hints.unknown_pairs(raw, pairs.where("gene <> 'g2'")).count() == 1
    assert [r.ordinal for r in hints.run_starts(pairs).orderBy("ordinal").collect()] == [0, 2, 3]
    assert {(r.gene, r.prot) for r in hints.best_supports(raw.where("type = 'Intron'"), 1, lexical=True).collect()} == {("g1", "p1"), ("g2", "p2")}


def test_lift_both_strands(spark):
    h = spark.createDataFrame([("x", "g", 5, 9, "+", 1), ("x", "r", 5, 9, "+", 2)], "seqid string, gene string, start long, end long, strand string, score int")
    regions = spark.createDataFrame([("g", 101, 200, "+", "c1"), ("r", 101, 200, "-", "c2")], "gene string, left long, right long, strand string, seqid string")
    assert sorted(map(tuple, hints.lift(h, regions).collect())) == [("c1", "g", 105, 109, "+", 1), ("c2", "r", 192, 196, "-", 2)]


def test_chains_shrink(spark):
    rows = [(1, 32), (1, 33), (1, 3), (101, 200), (1, 17)]
    df = spark.createDataFrame([("CDS", s, e, None, None) for s, e in rows], "type string, start long, end long, al_score double, splice_sites string")
    got = sorted((r.start, r.end) for r in hints.chains(df).collect())
    assert got == sorted([(16, 18), (16, 18), (1, 3), (116, 185), (7, 9)])


def test_classes_and_lines(spark):
    df = spark.createDataFrame([("c", "Intron", 1, 9, "+", n, al) for n, al in [(9, 0.0), (4, 0.25), (4, 0.3), (1, None)]], "seqid string, type string, start long, end long, strand string, score long, al_score double")
    got = {(r.score, r.al_score): r["class"] for r in hints.classify(df).collect()}  # median 4
    assert got == {(9, 0.0): 2, (4, 0.25): 2, (4, 0.3): 2, (1, None): 0}
    lines = {r.value for r in standard.export_lines(standard.exported(df, df, df.limit(0).selectExpr("*", "'' AS prot", "'' AS gene"))).collect()}
    assert "c\tprotein_hint\tintron\t1\t9\t0\t+\t.\tsrc=P;mult=1;pri=4;al_score=;" in lines and "c\tprotein_hint\tintron\t1\t9\t9\t+\t.\tsrc=M;mult=9;pri=4" in lines


def test_exons(spark):
    e = spark.createDataFrame(
        [("p", "g", 1, 40, 10, 130, 30.0, 0), ("p", "g", 41, 50, 9, 8, 99.0, 1), ("p", "g", 41, 80, 200, 300, 25.0, 2), ("p", "g", 81, 98, 400, 450, 26.0, 3), ("p", "g2", 1, 98, 10, 100, 24.0, 4)],
        "prot string, gene string, prot_start long, prot_end long, start long, end long, exon_score double, ordinal long",
    )
    assert [(r.start, r.end) for r in exons.introns(e).orderBy("start").collect()] == [(131, 199), (301, 399)]
    seq = "C" * 9 + "ATG" + "C" * 438 + "TAA" + "C" * 20
    regions = spark.createDataFrame([("g", seq), ("g2", seq)], "gene string, seq string")
    got = exons.terminal_codons(e, regions, spark.createDataFrame([("p", 100)], "prot string, length long")).collect()
    assert {(r.gene, r.type, r.start, r.end) for r in got} == {("g", "start_codon", 10, 12), ("g", "stop_codon", 451, 453)}


def test_standard_run(spark, raw):
    pairs = spark.createDataFrame([("g1", "p2", 0), ("g1", "p1", 1), ("g2", "p2", 2)], "gene string, prot string, ordinal long")
    standard.check_inputs(pairs, raw)
    with pytest.raises(ValueError, match="unknown pairs"):
        standard.check_inputs(pairs.where("gene <> 'g2'"), raw)
    out = standard.standard_run(raw, pairs)
    assert out.combined.count() == 4 and {r.seqid for r in out.evidence.collect()} == {"chr1", "chr2"}
    assert out.export.count() == out.combined.count() + out.evidence.count() + out.chains.count()


def test_config():
    for bad in ({"previous_seeds": "x"}, {"pairs": "x"}, {"chain_cut": 10}, {"max_proteins_per_seed": 0}):
        with pytest.raises(ValueError):
            EngineConfig(**bad)
