"""Sequences read in pieces: against whole sequences, over block borders, with odd lines."""

import random

import pytest
from pyspark.sql import functions as F

from hintforge.operators import genes
from hintforge.sources import sequences

rng = random.Random(4)


def whole(pieces, size):
    out = {}
    for r in sorted(pieces.collect(), key=lambda r: (r.seqid, r.chunk)):
        assert len(r.part) <= size and r.chunk == len(out.get(r.seqid, "")) // size and len(out.get(r.seqid, "")) % size == 0
        out[r.seqid] = out.get(r.seqid, "") + r.part
    return out


def test_pieces_of_files(spark, tmp_path):
    truth = {}
    for f in range(2):
        lines = []
        for k in range(6):
            seq = "".join(rng.choice("ACGTNacgtryk") for _ in range(rng.choice([0, 1, 5, 700, 4000])))
            truth[f"f{f}c{k}"] = seq
            width = rng.choice([7, 60, 5000])
            lines += [f">f{f}c{k} a note > more", *(seq[i : i + width] for i in range(0, len(seq), width)), *[""] * (k % 2)]
        (tmp_path / f"{f}.fa").write_text(("\r\n" if f else "\n").join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        read = sequences.fasta_rows(spark, str(tmp_path))
        assert read.select("file", "block").distinct().count() > 2
        for size in (64, 1000):
            got = whole(sequences.read_pieces(spark, str(tmp_path), size=size), size)
            assert got == {k: s.upper().translate(str.maketrans("RYK", "NNN")) for k, s in truth.items() if s}
        masked = whole(sequences.read_pieces(spark, str(tmp_path), mask_lower=True), 1 << 16)
        assert masked["f0c0"] == truth["f0c0"].translate(str.maketrans("acgt", "NNNN")).upper().translate(str.maketrans("RYK", "NNN")) if truth["f0c0"] else True
        assert {r.seqid: r.length for r in sequences.piece_lengths(sequences.read_pieces(spark, str(tmp_path), size=100)).collect()} == {k: len(s) for k, s in truth.items() if s}
        spans = spark.createDataFrame([(i, k, a := rng.randint(1, 600), a + rng.randint(0, 300)) for i, k in enumerate(truth)], "i int, seqid string, left long, right long")
        cut = {r.i: r.seq for r in genes.cut_out(spans, sequences.read_pieces(spark, str(tmp_path), size=128), ["i"], 128).collect()}
        old = {r.i: r.seq for r in genes.cut_out(spans, sequences.read_genome(spark, str(tmp_path)), ["i"], 128).collect()}
        assert cut == old and cut
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def lines_of(spark, *blocks):
    rows = [("f", b, 1000 * b + i, v) for b, some in enumerate(blocks) for i, v in enumerate(some)]
    return spark.createDataFrame(rows, "file string, block long, n long, value string")


def test_records_over_several_blocks(spark):
    lines = lines_of(spark, [">a x", "ACG"], ["TTTTT"], ["GG", ">b", ">c", "A"], ["CC"], [">a", "TT"], ["", "T"])
    got = sorted((r.seqid, r.chunk, r.part) for r in sequences.sequence_pieces(lines, size=4).collect())
    assert got == [("a", 0, "ACGT"), ("a", 0, "TTT"), ("a", 1, "TTTT"), ("a", 2, "GG"), ("c", 0, "ACC")]


def test_faults(spark):
    with pytest.raises(Exception, match="text before the first header of f"):
        sequences.sequence_pieces(lines_of(spark, ["ACG", ">a", "A"])).collect()
    with pytest.raises(Exception, match="not DNA: a"):
        sequences.sequence_pieces(lines_of(spark, [">a", "ACGE"])).collect()
    assert [tuple(r) for r in sequences.sequence_pieces(lines_of(spark, [">a", "MKV*e"]), dna=False).collect()] == [("a", 0, "MKV*E")]
    assert sequences.sequence_pieces(lines_of(spark, []).where(F.lit(False))).count() == 0


def test_a_long_contig_stays_in_pieces(spark, tmp_path):
    row = "ACGTTGCAAC" * 6 + "\n"
    with (tmp_path / "long.fa").open("w") as f:
        f.write(">long\n")
        for _ in range(400):
            f.write(row * 500)
    pieces = sequences.read_pieces(spark, str(tmp_path))
    sizes = pieces.agg(F.count("*"), F.sum(F.length("part")), F.max(F.length("part"))).first()
    assert tuple(sizes) == (-(-12_000_000 // 65_536), 12_000_000, 65_536)
