"""Combined hints that are kept up to date while genes come, change and go.

A feature's coverage is a sum and its alignment score a maximum over the hints of many genes, so a gene that goes can lower both. The state under
a path therefore keeps what each gene adds to each feature. It consists of three tables, to which every batch adds a folder of its own:

* genes/batch=n: the genes that the batch brings or takes away; a gene's last batch is the one that counts;
* parts/batch=n: what each of these genes adds to each feature, combined within the gene;
* features/batch=n: every feature that the batch could have changed, combined anew from all parts that count, or marked as gone.

A batch reads only earlier ones and overwrites its own folders, so running it again changes nothing, and one that was cut off is repaired by that.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hintforge.operators.hints import KEY, combine
from hintforge.storage import checkpoint_dir


def state_path(spark: SparkSession, name: str) -> str:
    """A new folder for a state, below the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _earlier(spark: SparkSession, path: str, table: str, schema, before: int | None) -> DataFrame:
    """The rows of a table's batches, of those before `before` if it is given. A table without batches is empty."""
    try:
        rows = spark.read.schema(f"{schema}, batch long").option("basePath", f"{path}/{table}").parquet(f"{path}/{table}/*")
    except Exception as e:  # the first batch finds no table
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], f"{schema}, batch long")
    return rows if before is None else rows.where(F.col("batch") < before)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def live_parts(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """What each gene adds, by its last batch."""
    last = _earlier(spark, path, "genes", "gene string", before).groupBy("gene").agg(F.max("batch").alias("batch"))
    return _earlier(spark, path, "parts", schema, before).join(last, ["gene", "batch"], "left_semi").drop("batch")


def apply_batch(hints: DataFrame, path: str, number: int, gone: DataFrame | None = None) -> DataFrame:
    """Brings the state at path up to date with batch `number`, and returns the features that it could have changed (with `gone`).

    hints(gene, seqid, type, start, end, strand, and what combine knows of) are all hints of the genes that are new or changed; they replace
    earlier ones of the same genes. gone(gene) lists genes that have none any more. Batches come in order of their numbers; every batch has the
    same columns. Hints without a gene belong to one nameless gene. Work and shuffles follow the batch: of the state only rows of touched
    features are moved.
    """
    spark = hints.sparkSession
    name = F.coalesce(F.col("gene").cast("string"), F.lit("")).alias("gene")
    parts = combine(hints.withColumn("gene", name), "gene")
    schema = _ddl(parts)
    names = hints.select(name)
    (names.unionByName(gone.select(name)) if gone is not None else names).distinct().write.mode("overwrite").parquet(f"{path}/genes/batch={number}")
    parts.write.mode("overwrite").parquet(f"{path}/parts/batch={number}")
    touched = spark.read.schema("gene string").parquet(f"{path}/genes/batch={number}")
    new = spark.read.schema(schema).parquet(f"{path}/parts/batch={number}")
    before = live_parts(spark, path, schema, number)
    keys = before.join(touched, "gene", "left_semi").select(*KEY).unionByName(new.select(*KEY)).distinct()
    rest = before.join(touched, "gene", "left_anti").join(keys, KEY, "left_semi")
    now = combine(rest.unionByName(new).drop("gene"))
    made = keys.join(now.withColumn("gone", F.lit(False)), KEY, "left").withColumn("gone", F.coalesce("gone", F.lit(True)))
    made.write.mode("overwrite").parquet(f"{path}/features/batch={number}")
    return spark.read.schema(made.schema).parquet(f"{path}/features/batch={number}")


def combined_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The combined hints as they stand after all batches, equal to combine over the hints of all genes. schema: the columns of combine's result."""
    rows = _earlier(spark, path, "features", f"{schema}, gone boolean", None)
    rest = [c for c in rows.columns if c not in (*KEY, "batch")]
    last = rows.groupBy(*KEY).agg(F.max_by(F.struct(*rest), "batch").alias("last")).where("NOT last.gone")
    return last.select(*KEY, *(F.col(f"last.{c}").alias(c) for c in rest if c != "gone"))


def watch_hints(hints: DataFrame, path: str, checkpoint: str):
    """Starts a stream that keeps the state at path. A gene's hints come in one batch; a row of a gene without type says that the gene is gone."""

    def step(batch: DataFrame, number: int) -> None:
        apply_batch(batch.where("type IS NOT NULL"), path, number, batch.where("type IS NULL").select("gene"))

    return hints.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
