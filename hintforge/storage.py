"""Results that are written once, so that later plans start from files and a lost executor loses nothing."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which every executor sees. A local session without one gets a temporary folder until the driver ends."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not known:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        known = tempfile.mkdtemp(prefix="hintforge-")
        atexit.register(shutil.rmtree, known, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", known)
    return known


def written(df: DataFrame) -> DataFrame:
    """df, computed now and kept in the checkpoint folder. With spark.cleaner.referenceTracking.cleanCheckpoints its files go when it is no longer used."""
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, computed now and kept as a Parquet table in the checkpoint folder: smaller than what `written` keeps."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
