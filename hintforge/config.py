"""Settings of the engine, checked when made."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Cutoffs:
    """Thresholds of the confidence filter; the defaults keep high-confidence hints."""

    intron_coverage: int = 4
    start_coverage: int = 4
    stop_coverage: int = 4
    intron_score: float = 0.25
    start_score: float = 0.01
    stop_score: float = 0.01
    start_overlap: int = 0
    #: Accept introns of any splice sites; of gc_ag besides gt_ag; hints of top proteins, or of fully aligned ones (introns only), at coverage 1.
    all_splice_sites: bool = False
    gc_ag: bool = False
    top_proteins: bool = False
    full_proteins: bool = False


#: Before combining: quality only. For chains of top proteins: quality only, too.
QUALITY = Cutoffs(0, 0, 0, 0.1, 0.01, 0.01, start_overlap=2**31 - 1, all_splice_sites=True)


@dataclass(frozen=True)
class EngineConfig:
    """What a run needs. Paths that come in pairs are checked here."""

    #: Files: seed genes; ranked pairs of seeds and proteins; raw hints made elsewhere; seeds and raw hints of the run before.
    seeds: str | None = None
    pairs: str | None = None
    alignments: str | None = None
    previous_seeds: str | None = None
    previous_alignments: str | None = None
    #: Proteins aligned with a seed; bases around a gene that are aligned with; longest gene (0: any); word of the engine's own search and the
    #: largest e-value of its pairs; a file of scores of letter pairs (none: by groups of amino acids); letters of a seed's protein at least.
    max_proteins_per_seed: int = 25
    window: int = 2000
    max_gene: int = 0
    word: int = 5
    e_value: float = 0.001
    matrix: str | None = None
    min_seed_protein: int = 1
    #: Regions and proteins of more letters are aligned in the `long` mode; tasks that the aligner's work is dealt into (0: as many as a shuffle has).
    long_gene: int = 30_000
    long_protein: int = 15_000
    align_tasks: int = 0
    #: Whether the aligner scores coding segments in al_score, and what they need then.
    cut_exons: bool = False
    min_exon_score: float = 25
    chain_cut: int = 15
    #: Compare upstream support by sequence and strand, too.
    strict_support: bool = False
    quality: Cutoffs = QUALITY
    cutoffs: Cutoffs = field(default_factory=Cutoffs)

    def __post_init__(self) -> None:
        if (self.previous_seeds is None) != (self.previous_alignments is None):
            raise ValueError("previous_seeds and previous_alignments are given together")
        if self.pairs is not None and self.seeds is None:
            raise ValueError("pairs need seeds")
        if self.alignments is not None and self.previous_seeds is not None:
            raise ValueError("alignments of this run and of the run before exclude each other")
        if self.chain_cut % 3 or self.chain_cut < 0:
            raise ValueError("chain_cut must be divisible by 3")
        for name, least in (("max_proteins_per_seed", 1), ("window", 0), ("max_gene", 0), ("word", 1), ("min_seed_protein", 0), ("e_value", 0), ("long_gene", 0), ("long_protein", 0), ("align_tasks", 0)):
            if getattr(self, name) < least:
                raise ValueError(f"{name} must be {least} or more")
