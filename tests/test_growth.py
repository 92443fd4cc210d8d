"""Steps that are done once, however many looks there are at their results, and bounded slices."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hintforge import adapter
from hintforge.functions.sequence import translate
from hintforge.operators import exons, genes, search
from hintforge.plans import standard
from hintforge.sources import features

SEEDS = "seqid string, type string, start long, end long, strand string, phase string, gene string, tx string, ordinal long"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_isoforms_move_rows_once(spark):
    rows = [("c", "CDS", 1, 10, "+", "0", "a", "t2", 2), ("c", "CDS", 1, 10, "+", "0", "a", "t1", 1), ("c", "exon", 1, 90, "+", ".", "a", "t1", 3), ("c", "CDS", 5, 5, "+", "0", "b", "t1", 1), ("c", "CDS", 5, 9, "+", "0", None, "t1", 1), ("c", "CDS", 5, 9, "+", "0", "d", None, 1)]
    kept = genes.keep_longest(spark.createDataFrame(rows, SEEDS))
    assert {(r.gene, r.tx, r.type) for r in kept.collect()} == {("a", "t1", "CDS"), ("a", "t1", "exon")}
    assert plan(kept).count("Repartition") == 1 and "Join" not in plan(kept)


def test_signatures_meet_by_digest(spark):
    rows = [("c", "CDS", 10 * i, 10 * i + 8, "+", "0", g, "t", i) for g in ("x", "y") for i in range(3)]
    new = spark.createDataFrame(rows + [("c", "CDS", 5, 9, "-", None, "z", "t", 1)], SEEDS)
    got = genes.changed_genes(new, spark.createDataFrame(rows, SEEDS))
    assert {(r.gene, r.old_gene) for r in got.collect()} == {("x", "y"), ("y", "y"), ("z", None)}
    assert "_same" in plan(got)


def test_sequences_are_looked_at_once_for_both_codons(spark):
    e = spark.createDataFrame([("p", "g", 1, 9, 4, 12, 30.0, 0)], "prot string, gene string, prot_start long, prot_end long, start long, end long, exon_score double, ordinal long")
    regions = spark.createDataFrame([("g", "CCCATGCCCCCCTGA")], "gene string, seq string")
    got = exons.terminal_codons(e, regions, spark.createDataFrame([("p", 10)], "prot string, length long"))
    assert {tuple(r) for r in got.collect()} == {("p", "g", "start_codon", 4, 6), ("p", "g", "stop_codon", 13, 15)}
    assert plan(got).count("Join") == 2 and "Union" not in plan(got)


def test_bases_of_texts(spark, tmp_path):
    texts = ["", None, "Acgt BdN\n1éKİzZ\U0001f600yn", "NNN"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = adapter.dna(spark, str(tmp_path))
    letters = str.maketrans("BDEFHIJKLMOPQRSUVWXYZ", "ACGTACGTACGTACGTACGTA")
    want = {i: None if t is None else "".join(c for c in t if c.isascii() and c.isalpha()).upper().translate(letters) for i, t in enumerate(texts)}
    assert {r.id: r.seq for r in found.collect()} == want
    assert "regexp_replace" not in plan(found.where("length(seq) > 2").select("id"))


def test_translation_is_not_done_again_for_a_condition(spark):
    texts = ["ATGAAATGA", "ATGTAA", "TAATGA", "", "AT", "ATGN", "ATGNNAéTGATGatg", None]
    want = ["MK", "M", "*", "", "", "M", "MXXMX", None]
    got = spark.createDataFrame(list(enumerate(texts)), "id long, seq string").repartition(2).withColumn("protein", translate(F.col("seq")))
    assert [r.protein for r in got.orderBy("id").collect()] == want
    assert plan(got.where("length(protein) > 1")).count("ArrowEvalPython") == 1


def test_lines_are_worked_out_once(spark):
    lines = ["c\tx\tCDS\t1\t9\t.\t+\t0\tprot=p; seed_gene_id=g;\r", " # no", "", "c\tx\tCDS\tone\t9\t.\t+\t0\ta", "c\tx"]
    df = spark.createDataFrame(list(enumerate(lines)), "ordinal long, line string").withColumn("line", F.concat("line", F.lit("")))
    assert [(r.ordinal, r.prot, r.gene) for r in features.parsed_hints(df).collect()] == [(0, "p", "g")]
    assert [r.ordinal for r in features.malformed_lines(df).orderBy("ordinal").collect()] == [3, 4]
    assert plan(features.parsed_hints(df)).count("split(") == 1


def test_hints_meet_pairs_once(spark):
    h = spark.createDataFrame([("c", "CDS", 1, 9, "+", 0.5, None, "p1", "g"), ("c", "CDS", 1, 9, "+", 0.5, None, "p2", "g")], "seqid string, type string, start long, end long, strand string, al_score double, splice_sites string, prot string, gene string")
    pairs = spark.createDataFrame([("g", "p2", 2), ("g", "p1", 1), ("g", "p2", 0)], "gene string, prot string, ordinal long")
    out = standard.standard_run(h, pairs)
    assert [r.prot for r in out.chains.collect()] == ["p2"] and "Join" not in plan(out.chains)


def test_slices_are_bounded():
    batch = pa.RecordBatch.from_arrays([pa.array(["s" * 10] * 50), pa.array(["t" * n for n in [5] * 49 + [900]])], ["seed", "target"])
    parts = list(search.slices(batch, ("seed", "target"), 100))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch])) and len(parts) > 5
    sizes = [sum(len(x) for c in p.columns for x in c.to_pylist()) for p in parts]
    assert max(sizes[:-1]) <= 120 and not list(search.slices(batch.slice(0, 0), ("seed", "target")))
    assert np.sum(sizes) == 50 * 10 + 49 * 5 + 900
