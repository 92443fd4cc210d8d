"""The command line on small files."""

import pytest

from hintforge.__main__ import main, parser
from hintforge.config import Cutoffs

LINES = "c\tx\tIntron\t10\t50\t{n}\t+\t.\tal_score={a}; splice_sites=gt_ag;\n"


def held(path):
    return sorted(x for p in path.glob("part-*") for x in p.read_text().splitlines())


def test_filter(spark, tmp_path):
    (tmp_path / "hints.gff").write_text(LINES.format(n=4, a=0.3) + LINES.format(n=3, a=0.3).replace("10", "12") + LINES.format(n=9, a=0.1).replace("10", "14"))
    main(["filter", str(tmp_path / "hints.gff"), str(tmp_path / "kept")])
    assert [x.split("\t")[3] for x in held(tmp_path / "kept")] == ["10"]
    main(["filter", str(tmp_path / "hints.gff"), str(tmp_path / "more"), "--intron-coverage", "3", "--intron-score", "0.1"])
    assert [x.split("\t")[3] for x in held(tmp_path / "more")] == ["10", "12", "14"]


def test_run_with_alignments(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">c\n" + "ACGT" * 100 + "\n")
    (tmp_path / "p.fa").write_text(">p\nMAC\n")
    (tmp_path / "s.gtf").write_text('c\tx\tCDS\t1\t60\t.\t+\t0\tgene_id "a"; transcript_id "a";\n')
    (tmp_path / "pairs").write_text("a\tp\n")
    (tmp_path / "raw.gff").write_text("c\tx\tIntron\t61\t100\t.\t+\t.\tprot=p; seed_gene_id=a; al_score=0.4; splice_sites=gt_ag;\n" * 4)
    path = lambda n: str(tmp_path / n)
    main(["run", path("g.fa"), path("p.fa"), path("out"), "--seeds", path("s.gtf"), "--pairs", path("pairs"), "--alignments", path("raw.gff")])
    assert len(held(tmp_path / "out/hints")) == len(held(tmp_path / "out/evidence")) == 1
    assert sorted(x.split("src=")[1][0] for x in held(tmp_path / "out/export")) == ["C"] * 4 + ["M", "P"] and len(held(tmp_path / "out/chains")) == 4
    with pytest.raises(ValueError, match="aligner"):
        import pandas as pd

        from hintforge.__main__ import unready

        unready(pd.DataFrame())


def test_thresholds_are_the_filters_own():
    given = parser().parse_args(["filter", "a", "b", "--gc-ag"])
    assert given.gc_ag and given.intron_coverage == Cutoffs().intron_coverage and not given.all_splice_sites
