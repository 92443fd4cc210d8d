"""Homology search and spliced alignment.

`scored_pairs` is the engine's own search: shared words give diagonals, the best ungapped run on each diagonal is scored and turned into an
e-value. Another search gives pairs(gene, prot, ordinal) as well, from a file or as a plug-in. Spliced alignment lives outside of the engine: an
aligner is called with batches of equal cost.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hintforge.storage import written


class HomologySearch(Protocol):
    def __call__(self, seeds: DataFrame, proteins: DataFrame) -> DataFrame: ...


class Aligner(Protocol):
    """Called with a row a pair: gene, prot, region and protein sequences, mode; returns hints in region coordinates."""

    def __call__(self, batch: pd.DataFrame) -> pd.DataFrame: ...


ALIGNED = "gene string, prot string, type string, start long, end long, strand string, al_score double, splice_sites string"


#: Words of seeds up to which they are broadcast; postings of one word in a task.
BROADCAST_WORDS, WORD_POSTINGS = 500_000, 10_000


def _words(df: DataFrame, name: str, k: int) -> DataFrame:
    """name, word, place (from 0): all overlapping words of k letters."""
    # a look-ahead yields every overlapping word in one pass
    found = F.regexp_extract_all("seq", F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))
    return df.select(F.col("id").alias(name), F.posexplode(found).alias("place", "word"))


def shared_words(seeds: DataFrame, proteins: DataFrame, k: int, postings: int = WORD_POSTINGS) -> tuple[DataFrame, DataFrame]:
    """(gene, word, place, part) and (prot, word, place, part): to be joined on word and part.

    Only words of seeds are moved on the proteins' side. A word with more than `postings` places there is dealt into so many parts that each
    has about that number, however frequent it is; the seeds' places of that word meet each part.
    """
    of_seed = _words(seeds, "gene", k)
    wanted = of_seed.select("word").distinct()
    # counted, so that the broadcast is known to be small
    few = wanted.count() <= BROADCAST_WORDS
    # written: taking words from sequences is most of the work, and what is left of them is read twice
    of_prot = written(_words(proteins, "prot", k).join(F.broadcast(wanted) if few else wanted, "word", "left_semi"))
    hot = of_prot.groupBy("word").agg(F.ceil(F.count("*") / postings).alias("parts")).where("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    dealt = of_prot.join(hot, "word", "left").withColumn("part", F.pmod(F.xxhash64("prot"), parts)).drop("parts")
    met = of_seed.join(hot, "word", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
    return met, dealt


def _best(scored: DataFrame, best: int) -> DataFrame:
    w = Window.partitionBy("gene").orderBy(F.desc("score"), "prot")
    return scored.withColumn("ordinal", F.row_number().over(w)).where(F.col("ordinal") <= best)


def kmer_pairs(seeds: DataFrame, proteins: DataFrame, k: int = 5, best: int = 25, least: int = 2) -> DataFrame:
    """gene, prot, score, ordinal: each seed's `best` proteins by distinct shared k-mers (at least `least`).

    seeds and proteins have id and seq. Every shared k-mer counts, however many proteins have it; pairs are counted within each task before they
    are moved.
    """
    of_seed, of_prot = (df.drop("place").distinct() for df in shared_words(seeds, proteins, k))
    shared = of_seed.join(of_prot, ["word", "part"]).groupBy("gene", "prot").agg(F.count("*").alias("score"))
    return _best(shared.where(F.col("score") >= least), best)


#: Amino acids that often stand for one another.
ALIKE = ("AGPST", "C", "DENQ", "FWY", "HKR", "ILMV")
#: Fixed value: the proportionality constant of e-values of ungapped runs.
E_FACTOR = 0.134


@dataclass(frozen=True, eq=False)
class Scoring:
    """Scores of letter pairs and what a score is worth.

    Without a table, equal letters score `equal`, letters of one group of ALIKE `alike`, all others (and letters of no group) `other`. A run of
    score S in m x n letters has the e-value factor * m * n * exp(-scale * S); without a given scale it is the positive root of
    sum p_i p_j exp(scale * s_ij) = 1 over equally frequent amino acids.
    """

    equal: int = 5
    alike: int = 1
    other: int = -3
    table: dict[tuple[str, str], int] | None = None
    given_scale: float | None = None
    factor: float = E_FACTOR

    @staticmethod
    def from_file(spark: SparkSession, path: str, scale: float | None = None, factor: float = E_FACTOR) -> Scoring:
        """A table in the usual text form: lines of `#` are comments, then a line of letters, then a line of a letter and its scores each.

        Such a file is a few kilobytes: its lines go to the driver.
        """
        rows = [r.value.split() for r in spark.read.text(path).collect() if r.value.strip() and not r.value.startswith("#")]
        return Scoring(table={(row[0], letter): int(n) for row in rows[1:] for letter, n in zip(rows[0], row[1:])}, given_scale=scale, factor=factor)

    def of(self, a: str, b: str) -> int:
        if self.table is not None:
            return self.table.get((a, b), min(self.table.values()))
        if not any(a in group and b in group for group in ALIKE):
            return self.other
        return self.equal if a == b else self.alike

    @cached_property
    def scores(self) -> np.ndarray:
        """By pairs of bytes."""
        letters = {x for pair in self.table for x in pair} if self.table is not None else set("".join(ALIKE))
        whole = np.full((256, 256), min(self.table.values()) if self.table is not None else self.other, np.int64)
        for a in letters:
            for b in letters:
                whole[ord(a), ord(b)] = self.of(a, b)
        return whole

    @cached_property
    def scale(self) -> float:
        if self.given_scale is not None:
            return self.given_scale
        acids = "".join(ALIKE)
        found = [self.of(a, b) for a in acids for b in acids]
        if max(found) <= 0 or sum(found) >= 0:
            raise ValueError("scores need a negative mean and a positive one among them")
        low, high = 0.0, 1.0
        excess = lambda x: sum(math.exp(x * s) for s in found) / len(found) - 1
        while excess(high) < 0:
            high *= 2
        for _ in range(100):
            mid = (low + high) / 2
            low, high = (mid, high) if excess(mid) < 0 else (low, mid)
        return high

    def e_value(self, score: Column, seed_length: Column, letters: Column) -> Column:
        return self.factor * seed_length * letters * F.exp(-self.scale * score)


#: Letters of diagonals that a task scores at one time.
RUN_LETTERS = 1 << 19
#: Bytes of sequences that a task holds as texts at one time, beside the batch they come in.
PAIR_BYTES = 4 << 20
HIT = "gene string, prot string, score long, diagonal int, seed_start int, seed_end int"


def best_runs(seeds: list[bytes], targets: list[bytes], diagonals: list[np.ndarray], scores: np.ndarray) -> np.ndarray:
    """For each pair a row (score, diagonal, start, end): the best run on any of its diagonals, start and end in the seed, from 1.

    Of equal runs the smallest diagonal counts, then the first end, then the last start.
    """
    flat_s, flat_t = (np.frombuffer(b"".join(x), np.uint8) for x in (seeds, targets))
    n_s, n_t = (np.array([len(x) for x in some], np.int64) for some in (seeds, targets))
    base_s, base_t = np.cumsum(n_s) - n_s, np.cumsum(n_t) - n_t
    pair = np.repeat(np.arange(len(seeds)), [len(d) for d in diagonals])
    diagonal = np.concatenate([np.zeros(0, np.int64), *diagonals]).astype(np.int64)
    first = np.maximum(0, -diagonal)
    length = np.minimum(n_s[pair], n_t[pair] - diagonal) - first
    found = np.zeros((len(pair), 3), np.int64)  # score, start, end
    cuts = np.unique(np.append(np.searchsorted(np.cumsum(length) // RUN_LETTERS, np.arange(int(length.sum()) // RUN_LETTERS + 2)), len(pair)))
    for a, b in zip(cuts, cuts[1:]):
        n = length[a:b]
        begin = np.cumsum(n) - n
        segment = np.repeat(np.arange(b - a), n)
        at = np.arange(int(n.sum())) - begin[segment] + first[a:b][segment]
        value = scores[flat_s[base_s[pair[a:b]][segment] + at], flat_t[base_t[pair[a:b]][segment] + at + diagonal[a:b][segment]]]
        upto = np.cumsum(value)
        before = upto - value
        lift = segment * (int(np.ptp(before)) + 1)  # each diagonal lies below all earlier ones, so one running minimum serves all
        low = np.minimum.accumulate(before - lift) + lift
        top = np.maximum.reduceat(upto - low, begin)
        ends = np.flatnonzero(upto - low == top[segment])
        _, one = np.unique(segment[ends], return_index=True)
        end = ends[one]
        starts = np.where(before == low[end][segment], np.arange(len(before)), -1)
        starts[np.arange(len(before)) > end[segment]] = -1
        found[a:b] = np.stack([top, at[np.maximum.reduceat(starts, begin)] + 1, at[end] + 1], axis=1)
    order = np.lexsort((diagonal, -found[:, 0], pair))
    _, one = np.unique(pair[order], return_index=True)
    best = order[one]
    return np.stack([found[best, 0], diagonal[best], found[best, 1], found[best, 2]], axis=1)


def slices(batch: pa.RecordBatch, texts: tuple[str, ...], size: int = PAIR_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices whose texts have about `size` bytes, one row at least."""
    n = sum(pc.binary_length(batch.column(batch.schema.names.index(t))).to_numpy(zero_copy_only=False).astype(np.int64) for t in texts)
    begin = (np.cumsum(n) - n) // size
    cuts = [0, *(np.flatnonzero(np.diff(begin)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def scored_pairs(seeds: DataFrame, proteins: DataFrame, k: int = 5, best: int = 25, e_value: float = 0.001, scoring: Scoring = Scoring()) -> DataFrame:
    """gene, prot, score, diagonal, seed_start, seed_end, e_value, ordinal: each seed's `best` proteins by their best ungapped run.

    seeds and proteins have id and seq. A shared word of k letters opens its diagonal (place in the protein minus place in the seed); the run is
    the one of highest score anywhere on such a diagonal. Kept are runs of at most e_value, which counts the letters of all proteins. Every
    shared word counts. Null or shorter sequences have no words; a protein's places and a pair's diagonals stay within a row.
    """
    scores = scoring.scores
    letters = proteins.agg(F.sum(F.length("seq"))).first()[0] or 0  # one number
    of_seed, of_prot = shared_words(seeds, proteins, k)
    met = of_seed.withColumnRenamed("place", "_place").join(of_prot, ["word", "part"]).groupBy("gene", "prot").agg(F.collect_set(F.col("place") - F.col("_place")).alias("diagonals"))
    rows = met.join(seeds.select(F.col("id").alias("gene"), F.col("seq").alias("seed")), "gene").join(proteins.select(F.col("id").alias("prot"), F.col("seq").alias("target")), "prot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, ("seed", "target")):
                col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
                texts = [[x.encode("latin-1", "replace") for x in col[n].to_pylist()] for n in ("seed", "target")]
                got = best_runs(*texts, [np.sort(d.values.to_numpy()) for d in col["diagonals"]], scores)
                yield pa.RecordBatch.from_arrays([col["gene"], col["prot"], pa.array(got[:, 0]), *(pa.array(got[:, i].astype(np.int32)) for i in (1, 2, 3)), pa.array([len(x) for x in texts[0]], pa.int64())], ["gene", "prot", "score", "diagonal", "seed_start", "seed_end", "letters"])

    hits = rows.select("gene", "prot", "diagonals", "seed", "target").mapInArrow(run, f"{HIT}, letters long")
    valued = hits.withColumn("e_value", scoring.e_value(F.col("score"), F.col("letters"), F.lit(letters))).drop("letters")
    return _best(valued.where(F.col("e_value") <= e_value), best)


#: Buckets of the first level of running costs: as many rows as their sums have.
COST_BUCKETS = 4096


def dealt_by_cost(pairs: DataFrame, regions: DataFrame, proteins: DataFrame, tasks: int, long_gene: int = 30_000, long_protein: int = 15_000) -> DataFrame:
    """gene, prot, cost, mode, task: pairs in tasks (from 0) of nearly equal cost, which is region length times protein length.

    regions(gene, length) and proteins(prot, length); pairs without either are left out. A pair goes to the task in which its share of the running
    cost begins, so no task has more than the mean and one pair. A gene's pairs lie together, so that its region goes to as few tasks as can be.
    Running costs have two levels: within buckets of genes, and over the sums of the buckets. mode is `long` where the region has more
    than long_gene or the protein more than long_protein letters, else `usual`.
    """
    known = pairs.select("gene", "prot").distinct().join(regions.select("gene", F.col("length").alias("_region")), "gene").join(proteins.select("prot", F.col("length").alias("_protein")), "prot")
    long = (F.col("_region") > long_gene) | (F.col("_protein") > long_protein)
    cost = known.select("gene", "prot", (F.col("_region") * F.col("_protein")).cast("long").alias("cost"), F.when(long, "long").otherwise("usual").alias("mode"), F.conv(F.substring(F.md5(F.col("gene").cast("string").cast("binary")), 1, 3), 16, 10).cast("int").alias("bucket"))
    sums = cost.groupBy("bucket").agg(F.sum(F.col("cost").cast("decimal(38,0)")).alias("bucket_cost"))
    # COST_BUCKETS rows at most
    before = F.sum("bucket_cost").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    level = sums.select("bucket", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("bucket_cost").over(Window.partitionBy()).alias("_total"))
    own = F.sum("cost").over(Window.partitionBy("bucket").orderBy("gene", "prot").rowsBetween(Window.unboundedPreceding, -1))
    begins = F.col("_before") + F.coalesce(own, F.lit(0)).cast("decimal(38,0)")
    task = F.when(F.col("_total") > 0, F.call_function("div", begins * tasks, F.col("_total"))).otherwise(0)
    placed = cost.join(F.broadcast(level), "bucket")
    return placed.select("gene", "prot", "cost", "mode", F.least(task, F.lit(tasks - 1)).cast("int").alias("task"))


def align(pairs: DataFrame, regions: DataFrame, proteins: DataFrame, aligner: Callable[[pd.DataFrame], pd.DataFrame], schema: str = ALIGNED, tasks: int | None = None, long_gene: int = 30_000, long_protein: int = 15_000) -> DataFrame:
    """The aligner's hints for all pairs, in tasks of equal cost (see dealt_by_cost). Pairs without region or protein sequence are left out.

    A task gets each of its regions once, with that gene's proteins; the aligner is called with a row a pair: gene, prot, region, protein, mode.
    """
    n = tasks or int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lengths = lambda df, key, name: df.select(F.col(key).alias(name), F.length("seq").cast("long").alias("length"))
    dealt = dealt_by_cost(pairs, lengths(regions, "gene", "gene"), lengths(proteins, "id", "prot"), n, long_gene, long_protein)
    with_protein = dealt.join(proteins.select(F.col("id").alias("prot"), F.col("seq").alias("protein")), "prot")
    by_gene = with_protein.groupBy("task", "gene").agg(F.collect_list(F.struct("prot", "protein", "mode")).alias("proteins"))
    rows = by_gene.join(regions.select("gene", F.col("seq").alias("region")), "gene").repartitionById(n, F.col("task"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for gene, region, some in zip(batch["gene"], batch["region"], batch["proteins"]):  # one region at a time, shared by its rows
                names = ("prot", "protein", "mode")
                yield aligner(pd.DataFrame({"gene": gene, "region": region, **{c: [p[c] for p in some] for c in names}})[["gene", "prot", "region", "protein", "mode"]])

    return rows.select("gene", "region", "proteins").mapInPandas(run, schema)
