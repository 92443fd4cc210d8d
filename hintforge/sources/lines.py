"""Lines of text files with their places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bits of monotonically_increasing_id that count the rows of a task.
ROW_BITS = 33


def placed_text(spark: SparkSession, path: str) -> DataFrame:
    """ordinal and value: the lines at path; ordinals grow in the order of files by name, and within a file in that of its lines.

    Tasks read blocks of files by falling size, several small files in one task, so only a block's lines are numbered as they are read; blocks are
    numbered by file and place: a row a block, found by a pass that keeps no text.
    """
    meta, row = F.col("_metadata"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    lines = spark.read.text(path).select("value", meta["file_path"].alias("_file"), meta["file_block_start"].alias("_at"), row.alias("_row"))
    blocks = lines.select("_file", "_at").distinct().withColumn("_block", F.row_number().over(Window.orderBy("_file", "_at")) - 1)
    placed = lines.join(F.broadcast(blocks), ["_file", "_at"])
    return placed.select((F.shiftleft(F.col("_block").cast("long"), ROW_BITS) + F.col("_row")).alias("ordinal"), "value")
