"""Seeds that arrive in batches: each batch is compared with those before, and only changed genes are worked on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from hintforge.operators.genes import signatures


def watch_seeds(seeds: DataFrame, known: str, work: Callable[[DataFrame, int], None], checkpoint: str):
    """Starts a stream over seeds; for each batch, `work` gets the rows of genes whose signature isn't in the table at `known` yet.

    A batch is written under its own number, so a batch that runs again after a failure overwrites its own rows only.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now = signatures(batch).select("gene", "signature")
        try:
            old = spark.read.parquet(f"{known}/*").where(f"batch <> {number}")
        except Exception as e:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(e):
                raise
            old = now.withColumn("batch", now["gene"].isNull().cast("long")).limit(0)
        new = now.join(old.select("signature"), "signature", "left_anti")
        work(batch.join(new.select("gene"), "gene", "left_semi"), number)
        new.selectExpr("gene", "signature", f"{number}L AS batch").write.mode("overwrite").parquet(f"{known}/batch-{number}")

    return seeds.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
