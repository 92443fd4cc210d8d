"""Combined hints kept up to date, against combining everything."""

import random

from pyspark.sql import functions as F

from hintforge.operators.hints import KEY, combine
from hintforge.streaming.combined import apply_batch, combined_state, state_path, watch_hints

SCHEMA = "gene string, seqid string, type string, start long, end long, strand string, score int, al_score double, splice_sites string, top boolean"
STATE = "seqid string, type string, start long, end long, strand string, score long, al_score double, splice_sites string, top boolean"


def hint(rng, gene):
    s = rng.randint(1, 12)
    return (gene, rng.choice("ab"), rng.choice(["Intron", "CDS"]), s, s + 30, rng.choice("+-"), rng.choice([None, 1, 4]), rng.choice([None, 0.1, 0.2, 0.5]), rng.choice([None, "gt_ag", "gc_ag"]), rng.choice([None, True, False]))


def rows(df):
    return sorted(map(repr, map(tuple, df.select(*KEY, "score", "al_score", "splice_sites", "top").collect())))


def test_state_equals_combining_all(spark):
    rng, path, world = random.Random(2), state_path(spark, "test"), {}
    for number in range(5):
        changed = {f"g{rng.randint(0, 14)}" for _ in range(6)} | ({None} if number == 1 else set())
        gone = {g for g in world if rng.random() < 0.2} - changed
        fresh = {g: [hint(rng, g) for _ in range(rng.randint(1, 12))] for g in changed}
        for _ in range(2 if number % 2 else 1):  # a batch that runs again
            touched = apply_batch(spark.createDataFrame([h for some in fresh.values() for h in some], SCHEMA), path, number, spark.createDataFrame([(g,) for g in gone], "gene string"))
        world = {g: some for g, some in (world | fresh).items() if g not in gone}
        want = rows(combine(spark.createDataFrame([h for some in world.values() for h in some], SCHEMA)))
        assert rows(combined_state(spark, path, STATE)) == want
        assert touched.count() <= sum(1 for _ in touched.select(*KEY).distinct().collect())
    assert want


def test_maxima_fall_when_their_gene_goes(spark):
    path, key = state_path(spark, "test"), ("a", "Intron", 1, 9, "+")
    apply_batch(spark.createDataFrame([("g", *key, 2, 0.9, "gt_ag", True), ("h", *key, 3, 0.4, "gc_ag", False)], SCHEMA), path, 0)
    assert rows(combined_state(spark, path, STATE)) == [repr((*key, 5, 0.9, "gt_ag", True))]
    apply_batch(spark.createDataFrame([], SCHEMA), path, 1, spark.createDataFrame([("g",)], "gene string"))
    assert rows(combined_state(spark, path, STATE)) == [repr((*key, 3, 0.4, "gc_ag", False))]
    apply_batch(spark.createDataFrame([], SCHEMA), path, 2, spark.createDataFrame([("h",), ("unknown",)], "gene string"))
    assert rows(combined_state(spark, path, STATE)) == [] and combined_state(spark, state_path(spark, "none"), STATE).count() == 0


def test_stream(spark, tmp_path):
    rng, path = random.Random(3), state_path(spark, "test")
    world = [hint(rng, f"g{i % 5}") for i in range(40)]
    spark.createDataFrame(world, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    watch_hints(stream, path, str(tmp_path / "check")).awaitTermination(120)
    spark.createDataFrame([("g1", *[None] * 9)], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    watch_hints(stream, path, str(tmp_path / "check")).awaitTermination(120)
    assert rows(combined_state(spark, path, STATE)) == rows(combine(spark.createDataFrame(world, SCHEMA).where(F.col("gene") != "g1")))
