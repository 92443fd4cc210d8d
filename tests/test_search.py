"""Scored search and batches of equal cost against brute force."""

import math
import random

import numpy as np
import pytest

from hintforge.operators import search
from hintforge.operators.search import ALIKE, Scoring, best_runs, dealt_by_cost, scored_pairs

rng = random.Random(5)
ACIDS = "".join(ALIKE)


def some(n):
    return "".join(rng.choice(ACIDS) for _ in range(n))


def mutated(text, share):
    return "".join(rng.choice(ACIDS) if rng.random() < share else c for c in text)


def brute(seed, target, k, scoring):
    """Of all runs on diagonals with a shared word the best: (score, diagonal, start, end)."""
    best = None
    for d in range(-len(seed) + 1, len(target)):
        places = [i for i in range(len(seed)) if 0 <= i + d < len(target)]
        if not any(seed[i : i + k] == target[i + d : i + d + k] and len(seed[i : i + k]) == k and i + k <= len(seed) and i + d + k <= len(target) for i in places):
            continue
        for a in places:
            total = 0
            for b in range(a, places[-1] + 1):
                total += scoring.of(seed[b], target[b + d])
                key = (-total, d, b + 1, -a)
                if best is None or key < best[0]:
                    best = (key, (total, d, a + 1, b + 1))
    return best[1] if best else None


def sequences():
    seeds = {f"s{i}": some(rng.randint(3, 60)) for i in range(12)} | {"low": "AAAAAAAAAAAAAAAAAAAA", "odd": "XXBZ*JOUACDEF", "none": "", "short": "ACD"}
    prots = {f"p{i}": some(20) + mutated(rng.choice([s for s in seeds.values() if s]), 0.15) + some(rng.randint(0, 20)) for i in range(40)} | {"lowp": "A" * 70, "oddp": "XXBZ*JOUACDEF", "nonep": ""}
    return seeds, prots


@pytest.mark.parametrize("scoring", [Scoring(), Scoring(table={(a, b): 4 if a == b else -2 + (a in "ILMV" and b in "ILMV") * 3 for a in ACIDS for b in ACIDS})])
def test_scored_pairs(spark, scoring, monkeypatch):
    monkeypatch.setattr(search, "RUN_LETTERS", 500)
    seeds, prots = sequences()
    frames = [spark.createDataFrame([*x.items(), (f"null{i}", None)], "id string, seq string") for i, x in enumerate((seeds, prots))]
    got = {}
    for r in scored_pairs(*frames, k=3, best=6, e_value=0.5, scoring=scoring).collect():
        got.setdefault(r.gene, {})[r.ordinal] = (r.prot, r.score, r.diagonal, r.seed_start, r.seed_end, round(math.log(r.e_value), 6))
    letters = sum(map(len, prots.values()))
    for s, seed in seeds.items():
        hits = []
        for p, target in prots.items():
            if run := brute(seed, target, 3, scoring):
                e = scoring.factor * len(seed) * letters * math.exp(-scoring.scale * run[0])
                if e <= 0.5:
                    hits.append((-run[0], p, (p, *run, round(math.log(e), 6))))
        assert got.get(s, {}) == {i + 1: h[2] for i, h in enumerate(sorted(hits)[:6])}, s
    assert any(got.values())


def test_frequent_words_are_split(spark):
    seeds = spark.createDataFrame([("s", "ACDEFGH")], "id string, seq string")
    prots = spark.createDataFrame([(f"p{i:03}", "ACDEFGH") for i in range(300)], "id string, seq string")
    met, dealt = search.shared_words(seeds, prots, 5, postings=50)
    assert met.count() == 3 * 6 and max(r["count"] for r in dealt.groupBy("word", "part").count().collect()) < 90
    assert dealt.join(met, ["word", "part"]).count() == 900


def test_scale_solves_its_equation_and_tables_are_read(spark, tmp_path):
    s = Scoring()
    assert abs(sum(math.exp(s.scale * s.of(a, b)) for a in ACIDS for b in ACIDS) / 400 - 1) < 1e-9
    with pytest.raises(ValueError, match="negative mean"):
        Scoring(equal=50).scale
    (tmp_path / "m.txt").write_text("# comment\n   A  R  *\nA  4 -1 -4 \nR -1  5 -4\n*  -4 -4  1\n")
    read = Scoring.from_file(spark, str(tmp_path / "m.txt"), scale=0.3)
    assert (read.of("A", "R"), read.of("R", "R"), read.of("A", "W"), read.scale) == (-1, 5, -4, 0.3)
    assert read.scores[ord("A"), ord("*")] == -4 and read.scores[ord("W"), ord("W")] == -4


def test_runs_of_no_pairs():
    assert best_runs([], [], [], Scoring().scores).shape == (0, 4)
    assert best_runs([b"AC"], [b"AC"], [np.array([0])], Scoring().scores).tolist() == [[10, 0, 1, 2]]


def skewed(spark):
    genes = [(f"g{i}", 50_000 if i % 20 == 0 else rng.randint(1, 3000)) for i in range(300)]
    prots = [(f"p{i}", 20_000 if i % 30 == 0 else rng.randint(50, 900)) for i in range(200)]
    pairs = [(g, p) for g, _ in genes for p, _ in rng.sample(prots, rng.choice([1, 2, 25]))] + [("g0", "none"), ("none", "p0")]
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    return dict(genes), dict(prots), pairs, make(pairs + pairs[:5], "gene string, prot string"), make(genes, "gene string, length long"), make(prots, "prot string, length long")


def test_tasks_cost_the_same(spark):
    g, p, pairs, *frames = skewed(spark)
    rows = dealt_by_cost(*frames, tasks=8).collect()
    assert sorted((r.gene, r.prot, r.cost, r.mode) for r in rows) == sorted((a, b, g[a] * p[b], "long" if g[a] > 30_000 or p[b] > 15_000 else "usual") for a, b in pairs if a in g and b in p)
    cost = {t: sum(r.cost for r in rows if r.task == t) for t in range(8)}
    assert max(cost.values()) <= sum(cost.values()) / 8 + max(r.cost for r in rows) and max(cost.values()) < 2 * sum(cost.values()) / 8
    assert sum(len({r.task for r in rows if r.gene == x}) for x in g) <= len(g) + 7  # a gene is cut at a task's border only
    assert dealt_by_cost(frames[0].limit(0), *frames[1:], tasks=3).count() == 0


def test_aligner_sees_a_region_once_and_its_mode(spark):
    g, p, pairs, frame, *_ = skewed(spark)
    regions = spark.createDataFrame([(k, "A" * n) for k, n in g.items()], "gene string, seq string")
    prots = spark.createDataFrame([(k, "M" * n) for k, n in p.items()], "id string, seq string")

    def aligner(batch):
        from pyspark import TaskContext

        assert batch["gene"].nunique() == 1 and list(batch.columns) == ["gene", "prot", "region", "protein", "mode"]
        out = batch[["gene", "prot", "mode"]].copy()
        out["n"], out["m"], out["task"] = batch["region"].str.len(), batch["protein"].str.len(), TaskContext.get().partitionId()
        return out

    rows = search.align(frame, regions, prots, aligner, "gene string, prot string, mode string, n long, m long, task int", tasks=6).collect()
    assert sorted((r.gene, r.prot, r.n, r.m) for r in rows) == sorted({(a, b, g[a], p[b]) for a, b in pairs if a in g and b in p})
    assert all(r.mode == ("long" if r.n > 30_000 or r.m > 15_000 else "usual") for r in rows)
    cost = {t: sum(r.n * r.m for r in rows if r.task == t) for t in {r.task for r in rows}}
    assert len(cost) == 6 and max(cost.values()) < 2 * sum(cost.values()) / 6
