"""Statistics of a run as bucketed tables: round trip, and a next iteration that doesn't shuffle them."""

import uuid

from pyspark.sql import functions as F

from hintforge.operators import genes
from hintforge.plans import standard
from hintforge.sources.statistics import read_statistics, save_statistics

SEEDS = "seqid string, type string, start long, end long, strand string, phase string, gene string, tx string, ordinal long"


def seeds(spark, moved=()):
    rows = [("c", "CDS", 100 * g + 40 * k + (g in moved), 100 * g + 40 * k + 30, "+", "0", f"{'n' if moved else 'o'}{g}", f"t{g}", 10 * g + k) for g in range(30) for k in range(2)]
    return spark.createDataFrame(rows, SEEDS)


def test_round_trip_and_no_exchange(spark, tmp_path):
    name = f"run_{uuid.uuid4().hex[:8]}"
    old, new = seeds(spark), seeds(spark, moved=(3, 4, 5))
    hints = old.select("seqid", "type", "start", "end", "strand", "gene", F.lit("p").alias("prot"))
    pairs = old.select("gene", F.lit("p").alias("prot"), F.lit(1).alias("ordinal")).distinct()
    confs = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "true"}
    before = {k: spark.conf.get(k) for k in confs}
    try:
        save_statistics(old, pairs, hints, name, buckets=4)
        kept = read_statistics(spark, name)
        for got, want in ((kept.extents, genes.extents(old)), (kept.pairs, pairs), (kept.hints, hints), (kept.signatures, genes.signatures(old))):
            assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
        fresh = lambda unique: unique.select(*hints.columns[:6], F.lit("q").alias("prot"))
        unique, raw = standard.next_iteration(new, kept.signatures, kept.hints, fresh)
        plain = standard.next_iteration(new, old, hints, fresh)
        assert sorted(map(tuple, raw.collect())) == sorted(map(tuple, plain[1].select(*raw.columns).collect()))
        assert {r.gene for r in unique.collect()} == {"n3", "n4", "n5"}
        for k, v in confs.items():
            spark.conf.set(k, v)
        unique, raw = standard.next_iteration(new, kept.signatures, kept.hints, fresh)
        for df in (unique, raw):
            scans, shuffled = tables_of(df._jdf.queryExecution().executedPlan(), False)
            assert scans and not shuffled, shuffled
        extents = kept.extents.join(kept.pairs, "gene").join(unique.select("gene").distinct(), "gene", "left_anti")
        assert not tables_of(extents._jdf.queryExecution().executedPlan(), False)[1] & {f"{name}_extents", f"{name}_pairs"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        for what in ("extents", "pairs", "hints", "signatures"):
            spark.sql(f"DROP TABLE IF EXISTS {name}_{what}")


def tables_of(node, below):
    """Tables that are scanned, and those of them whose rows are shuffled before they meet the first join."""
    kind, scans, shuffled = node.nodeName(), set(), set()
    below = below or "Exchange" in kind
    if "Join" in kind:
        below = False
    children = node.children()
    if children.size() == 0 and "Scan parquet" in kind:
        table = kind.rpartition(".")[2].split(" ")[0]
        return {table}, {table} if below else set()
    for i in range(children.size()):
        s, x = tables_of(children.apply(i), below)
        scans |= s
        shuffled |= x
    return scans, shuffled
