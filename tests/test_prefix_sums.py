"""Overlaps from prefix sums and runs found in ranges, against loops."""

import random

from pyspark.sql import functions as F

from hintforge import catalog
from hintforge.operators import hints

rng = random.Random(8)
SCHEMA = "seqid string, type string, start long, end long, strand string, score int"


def test_overlaps_from_sums(spark):
    for deep in (30, 3000):
        cds = [(rng.choice("ab"), "CDS", s := rng.randint(1, deep), s + rng.choice([0, 1, 2, 3, 20, 500, 4000]), rng.choice("+-"), rng.choice([None, 1, 7])) for _ in range(400)]
        starts = sorted({(rng.choice("abc"), "start_codon", s := rng.randint(1, deep + 50), s + rng.choice([2, 2, 2, 0, 5]), rng.choice("+-"), 1) for _ in range(150)})
        frames = spark.createDataFrame(starts, SCHEMA), spark.createDataFrame(cds, SCHEMA)
        want = sorted((*s, sum(c[5] or 1 for c in cds if c[0] == s[0] and c[2] < s[2] and c[3] > s[3])) for s in starts)
        for width in (7, 10_000):
            assert sorted(map(tuple, hints.count_overlaps_summed(*frames, width).collect())) == want
        assert sorted(map(tuple, hints.count_overlaps(*frames).select(*frames[0].columns, "cds_overlap").collect())) == want
    assert {r.cds_overlap for r in hints.count_overlaps_summed(frames[0], frames[1].limit(0)).collect()} == {0}
    assert hints.count_overlaps_summed(frames[0].limit(0), frames[1]).count() == 0


def test_no_pair_is_made_where_every_start_lies_in_all_segments(spark):
    cds = spark.range(10_000).selectExpr("'a' || id % 1 AS seqid", "'CDS' AS type", "id AS start", "id + 100000 AS end", "'+' AS strand", "1 AS score")
    starts = spark.range(2_000).selectExpr("'a' || id % 1 AS seqid", "'start_codon' AS type", "id + 20000 AS start", "id + 20002 AS end", "'+' AS strand", "1 AS score")
    counted = hints.count_overlaps_summed(starts, cds)
    assert [tuple(r) for r in counted.groupBy("cds_overlap").count().collect()] == [(10_000, 2_000)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_runs_across_ranges(spark):
    for n, kinds, parts in ((1, 1, 4), (50, 2, 7), (300, 5, 16), (300, 1, 8), (40, 3, 1)):
        genes = [rng.choice([None, *"abcde"][: kinds + 1]) for _ in range(n)]
        places = sorted(rng.sample(range(10 * n), n))
        rows = [(g, f"p{i}", o) for i, (g, o) in enumerate(zip(genes, places))]
        rng.shuffle(rows)
        got = hints.run_starts(spark.createDataFrame(rows, "gene string, prot string, ordinal long"), parts)
        want = [o for i, (g, o) in enumerate(zip(genes, places)) if g != (genes[i - 1] if i else None)]
        assert sorted(r.ordinal for r in got.collect()) == want
        assert min(parts, n) == 1 or "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    assert hints.run_starts(spark.createDataFrame([], "gene string, prot string, ordinal long")).count() == 0


def test_places_in_a_list(spark):
    rows = [(f"g{rng.randrange(9)}", f"p{i}", rng.choice([5, 7, 7, 9])) for i in range(500)]
    rng.shuffle(rows)
    got = hints.listed(spark.createDataFrame(rows, "gene string, prot string, score long").repartition(5), F.desc("score"), "gene", "prot")
    want = sorted(rows, key=lambda r: (-r[2], r[0], r[1]))
    assert [tuple(r) for r in got.orderBy("ordinal").collect()] == [(*r, i + 1) for i, r in enumerate(want)]
    assert hints.listed(spark.createDataFrame([], "gene string, prot string, score long"), F.desc("score"), "gene").count() == 0


def test_run_starts_query_ranks_all_pairs(spark):
    """The places are those among all pairs, from 1 on without gaps, as the query's SQL had them at first."""
    assert "row_number() OVER (ORDER BY sc DESC, gene, prot)" in catalog.oracle_sql()["run_starts"]
    got = catalog.queries()["run_starts"](spark, "/root/testdata/sf0.001").agg(F.min("ordinal").alias("a"), F.max("ordinal").alias("b")).first()
    assert got.a == 1 and got.b <= catalog.queries()["pair_counts"](spark, "/root/testdata/sf0.001").agg(F.sum("n_pairs").alias("n")).first().n
