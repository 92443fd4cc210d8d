"""Scores and classes of single hints as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hintforge.config import Cutoffs

# A fitted linear predictor of a hint's class and the value from which it counts as strong.
INTERCEPT, PER_COVERAGE, PER_SCORE, STRONG = -4.00529, 4.73909, 9.09026, 0.85


def coverage(score: Column) -> Column:
    """A score of `.` (null) counts one alignment."""
    return F.coalesce(score.cast("int"), F.lit(1))


def strength(score: Column, median: Column, al_score: Column) -> Column:
    """The linear predictor; a missing alignment score counts 0."""
    return F.lit(INTERCEPT) + F.lit(PER_COVERAGE) * (score / median) + F.lit(PER_SCORE) * F.coalesce(al_score, F.lit(0.0))


def priority_class(score: Column, median: Column, al_score: Column) -> Column:
    return F.when(strength(score, median, al_score) >= STRONG, 2).otherwise(0)


def confident(c: Cutoffs, score="score", al_score="al_score", splice_sites=None, top=None, full=None, overlap=None, kind="type") -> Column:
    """The confidence filter for one row. Columns that a table lacks are None: no splice site is rejected, nothing is top, no start overlaps.

    An intron without alignment score fails; a start or stop without one passes that test. Other types always pass.
    """
    yes = lambda name: F.coalesce(F.col(name), F.lit(False)) if name else F.lit(False)
    n, al, what = coverage(F.col(score)), F.col(al_score), F.lower(F.col(kind))
    site = F.lower(F.col(splice_sites)) if splice_sites else F.lit(None).cast("string")
    sites = ["gt_ag"] + ["gc_ag"] * c.gc_ag
    known = F.lit(True) if c.all_splice_sites else site.isNull() | site.isin(sites)
    is_top = yes(top) & F.lit(c.top_proteins)
    at_least = lambda least, also=F.lit(False): F.when(is_top | also, 1).otherwise(least)
    intron = known & (n >= at_least(c.intron_coverage, yes(full) & F.lit(c.full_proteins))) & (F.coalesce(al, F.lit(-1.0)) >= c.intron_score)
    stop = (n >= at_least(c.stop_coverage)) & (F.coalesce(al, F.lit(1.0)) >= c.stop_score)
    start = (n >= at_least(c.start_coverage)) & (F.coalesce(al, F.lit(1.0)) >= c.start_score)
    if overlap:
        start = start & (F.coalesce(F.col(overlap), F.lit(0)) <= c.start_overlap)
    return F.when(what == "intron", intron).when(what == "stop_codon", stop).when(what == "start_codon", start).otherwise(F.lit(True))


def shrunk(start: Column, end: Column, cut: int = 15) -> tuple[Column, Column]:
    """A coding segment made shorter by `cut` at both ends; short ones keep one codon in their middle."""
    size = end - start + 1
    middle = start + F.floor(size / 6) * 3
    return F.when(size < 2 * cut + 3, middle).otherwise(start + cut), F.when(size < 2 * cut + 3, middle + 2).otherwise(end - cut)
