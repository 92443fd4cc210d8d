"""Small helpers that several training-data operators share."""

from __future__ import annotations

import atexit
import contextvars
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table that may be broadcast: names and numbers, some tens of bytes each.
BROADCAST_ROWS = 1_000_000
#: Bytes of text that a Python task holds as word objects at one time.
CHUNK_BYTES = 4 << 20
#: The same where some dozens of bytes are held for each byte of text.
SLICE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which every executor sees.

    A local session without such a setting (tests, a laptop) gets a temporary folder until the driver ends; a cluster's must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="hintforge-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Rows of an Arrow batch at most while a table is written: texts of some kilobytes, held by Spark and by Python at once.
ARROW_ROWS = 2000


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Spark's settings while the block runs."""
    before = {n: spark.conf.get(n, None) for n in values}
    for n, v in values.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: later plans start from files and survive lost executors."""
    path = written(df, name)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    scope = SCOPE.get()
    if scope is not None:
        scope.made.append((path, out))
    return out


def stored_apart(df: DataFrame, name: str, column: str) -> tuple[DataFrame, DataFrame]:
    """The rows of df where a boolean column is false, and those where it is true, written in one pass as two tables, of which each may go before the other."""
    path = written(df, name, column)
    rest, some = (df.sparkSession.read.schema(df.schema).parquet(path).where(F.col(column) == F.lit(v)).drop(column) for v in (False, True))
    scope = SCOPE.get()
    if scope is not None:
        scope.made += [(f"{path}/{column}=true", some), (path, rest)]
    return rest, some


def written(df: DataFrame, name: str, column: str | None = None) -> str:
    """The new folder that df is written to, in parts by column if there is one. Shuffle files of the plan go at once, not when the driver collects garbage."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    own = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= ARROW_ROWS:
        own["spark.sql.execution.arrow.maxRecordsPerBatch"] = str(ARROW_ROWS)
    if column:  # a task writes both parts side by side, without sorting its rows
        own["spark.sql.maxConcurrentOutputFileWriters"] = "2"
    with settings(spark, own):
        (df.write.partitionBy(column) if column else df.write).parquet(path)
    return path


class Scope:
    """Tables written since the scope was opened, and those of them that stay."""

    def __init__(self) -> None:
        self.made: list[tuple[str, DataFrame]] = []
        self.kept: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept.append(df)
        return df


SCOPE: contextvars.ContextVar[Scope | None] = contextvars.ContextVar("scope", default=None)


@contextmanager
def passing() -> Iterator[Scope]:
    """Deletes what `stored` writes inside at its end, but for what the scope is told to keep, which the scope around then holds.

    Whatever leaves the block must be a kept table or be computed by then.
    """
    outer, scope = SCOPE.get(), Scope()
    token = SCOPE.set(scope)
    try:
        yield scope
    finally:
        SCOPE.reset(token)
        for path, df in scope.made:
            if not any(df is k for k in scope.kept):
                delete(path, df.sparkSession)
            elif outer is not None:
                outer.made.append((path, df))


def delete(path: str, spark: SparkSession) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def discard(df: DataFrame) -> None:
    """Deletes a written table that nothing reads any more before its scope ends."""
    scope = SCOPE.get()
    for at in [x for x in scope.made if x[1] is df] if scope else []:
        delete(at[0], df.sparkSession)
        scope.made.remove(at)


def maybe_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df, marked for broadcast if it has (or holds, if told) BROADCAST_ROWS rows at most. df is a written table, as it may be counted."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores before it until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def give_back() -> None:
    """Hands what Arrow and numpy have freed back to the system: a worker outlives its tasks, and several wait in each executor."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
        trim(0)


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches in slices of about limit bytes of text, with each row's text as UTF-8 (null: empty).

    A single longer text makes a slice of its own. Freed memory goes back to the system before each batch and after each slice.
    """
    for batch in batches:
        give_back()
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        group = np.cumsum(_lengths(col)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            texts = part.column(part.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
            yield part, [t or b"" for t in texts]
            give_back()


def _lengths(col: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def segment_ids(counts: np.ndarray) -> np.ndarray:
    """[2, 0, 3] -> [0, 0, 2, 2, 2]."""
    return np.repeat(np.arange(len(counts)), counts)


def sorted_within(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The order by owner (from 0), then by value."""
    order = np.argsort(values)
    small = owner.astype(np.uint16) if not len(owner) or owner.max() < 1 << 16 else owner  # numpy sorts 16-bit numbers in linear time
    return order[np.argsort(small[order], kind="stable")]


def ragged_take(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces flat[starts[i] : starts[i] + lengths[i]], one after the other."""
    if not len(starts):
        return flat[:0]
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]))]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
