"""Clusters of vectors around integer centroids, by partial-distance search (operator 13).

Components become integers, floor(256 * x). In each round a task measures its vectors over the dimensions of highest variance first: squared
differences over the first few dimensions go for all centroids, the most promising centroid is finished, and any other is abandoned as soon as
its partial sum is strictly above that distance. What survives all dimensions has its exact distance, so nothing is approximate. A task sends
its sums by cluster and dimension; the driver sees as many as centroids have components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hintforge.llm.common import stored

#: Dimensions measured for all centroids before the first is finished, and at a time after that.
FIRST, STEP = 12, 6
#: Largest component: squared distances over thousands of dimensions still fit into 64 bits.
LARGEST = 1 << 24
#: Vectors measured at one time.
ROWS = 4096


def whole_numbers(col: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are vectors of dims finite components, and those as floor(256 * x) in 32 bits."""
    kept = pc.fill_null(pc.equal(pc.list_value_length(col), dims), False)
    values = col.filter(kept).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)  # nulls become NaN
    finite = np.isfinite(values).all(axis=1)
    rows = kept.to_numpy(zero_copy_only=False).astype(bool)
    rows[rows] = finite
    with np.errstate(over="ignore"):
        scaled = np.floor(256 * values[finite])
    if scaled.size and not np.abs(scaled).max() <= LARGEST:
        raise ValueError(f"a vector component is beyond {LARGEST // 256}: squared distances would not fit into 64 bits")
    return rows, scaled.astype("<i4")


def integer_vectors(vectors: DataFrame, dims: int, id_column: str, column: str) -> DataFrame:
    """vec_id and code (components as little-endian 32-bit integers) of the vectors that are kept, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ints = whole_numbers(batch.column(1), dims)
            codes = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * dims), len(ints), [None, pa.py_buffer(ints.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(rows)), codes], ["vec_id", "code"])

    read = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("components"))
    return stored(read.mapInArrow(run, "vec_id long, code binary"), "vectors")


def components(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[slice, np.ndarray]]:
    """The vectors of a batch as 64-bit integers, some thousand at a time."""
    codes = batch.column(batch.schema.get_field_index("code"))
    flat = np.frombuffer(b"".join(codes.to_pylist()), "<i4").reshape(-1, dims)
    for at in range(0, len(flat), ROWS):
        yield slice(at, at + ROWS), flat[at : at + ROWS].astype(np.int64)


def nearest(vectors: np.ndarray, centroids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid (of several, the smallest number), over the dimensions in `order`."""
    x, c = vectors[:, order], centroids[:, order]
    n, dims = x.shape
    every = np.arange(n)
    square = lambda d: np.einsum("ij,ij->i", d, d)
    part = np.stack([square(x[:, :FIRST] - row) for row in c[:, :FIRST]], axis=1)
    guess = part.argmin(axis=1)
    best = part[every, guess] + square(x[:, FIRST:] - c[guess, FIRST:])
    row, number = np.nonzero(part <= best[:, None])
    total = part[row, number]
    for at in range(FIRST, dims, STEP):
        total = total + square(x[row, at : at + STEP] - c[number, at : at + STEP])
        alive = total <= best[row]
        row, number, total = row[alive], number[alive], total[alive]
    # the guess survives, so each vector has a run of survivors in order of their numbers
    first = np.searchsorted(row, every)
    least = np.minimum.reduceat(total, first) if n else total
    winners = np.flatnonzero(total == least[row])
    _, at = np.unique(row[winners], return_index=True)
    return number[winners[at]].astype(np.int32), least


def summed(made: DataFrame) -> dict[tuple[int, int], int]:
    """The sums of value by (cluster, part), exact; made has a row for each of them and task, and as many are left as centroids have numbers."""
    rows = made.groupBy("cluster", "part").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    return {(r.cluster, r.part): int(r.value) for r in rows}


def sums_batch(table: np.ndarray) -> pa.RecordBatch:
    """A task's rows of summed, without zeros."""
    cluster, part = np.nonzero(table)
    return pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(part, pa.int32()), pa.array(table[cluster, part])], ["cluster", "part", "value"])


SUMS = "cluster int, part int, value long"


def dimension_order(coded: DataFrame, dims: int) -> np.ndarray:
    """Dimensions by falling variance. It decides how early centroids are abandoned, never which is nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in components(batch, dims):
                y = x - x.mean(axis=0).astype(np.int64)  # within some thousand vectors: an order needs no more
                yield sums_batch((y * y).sum(axis=0)[None, :] // len(y))

    found = summed(coded.mapInArrow(run, SUMS))
    return np.array(sorted(range(dims), key=lambda d: (-found.get((0, d), 0), d)))


def moved(coded: DataFrame, centroids: np.ndarray, order: np.ndarray) -> np.ndarray:
    """One round: every vector goes to its nearest centroid, every non-empty centroid to the floor of its vectors' mean."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims + 1), np.int64)  # the last part counts
        for batch in batches:
            for _, x in components(batch, dims):
                number, _ = nearest(x, centroids, order)
                by = np.argsort(number, kind="stable")
                found, first = np.unique(number[by], return_index=True)
                sums[found, :dims] += np.add.reduceat(x[by], first, axis=0)
                sums[:, dims] += np.bincount(number, minlength=k)
        yield sums_batch(sums)

    found = summed(coded.mapInArrow(run, SUMS))
    return np.array([[found.get((c, d), 0) // found[c, dims] for d in range(dims)] if (c, dims) in found else row for c, row in enumerate(centroids.tolist())], np.int64)


def first_centroids(coded: DataFrame, clusters: int, dims: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of `2:<vec_id>`. Rows without vec_id come last; equal ones go by their components' bytes."""
    named = coded.select("code", F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256).alias("h"))
    rows = named.orderBy(F.col("h").asc_nulls_last(), "code").limit(clusters).collect()  # as many rows as there are centroids
    return np.array([np.frombuffer(r.code, "<i4") for r in rows], np.int64).reshape(-1, dims)


def cluster_vectors(vectors: DataFrame, clusters: int = 40, rounds: int = 5, dims: int = 64, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256, one row for each kept row of vectors(vec_id long, embedding array).

    Kept are vectors of `dims` components, none null or not finite; null arrays and other lengths give no row. Repeated rows each count and each
    give a row, null vec_ids stay null, ties go to the smaller centroid, other columns are not read. With fewer vectors than clusters, each
    starts a centroid; an empty table gives an empty one. A component beyond 65,536 is an error, as distances are 64-bit integers.
    """
    spark = vectors.sparkSession
    coded = integer_vectors(vectors, dims, id_column, column)
    centroids = first_centroids(coded, clusters, dims)
    order = dimension_order(coded, dims) if len(centroids) else np.arange(dims)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(coded, centroids, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in components(batch, dims):
                number, distance = nearest(x, centroids, order)
                yield pa.RecordBatch.from_arrays([batch.column(0)[at], pa.array(number), pa.array(distance)], ["vec_id", "cluster", "distance"])

    kept = "vec_id long, cluster int, distance long"
    assigned = stored(coded.mapInArrow(run, kept) if len(centroids) else spark.createDataFrame([], kept), "assigned")
    by_cluster = {r.cluster: r.d for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # a row a centroid
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(k, d, sum(by_cluster.values()), digest[k]) for k, d in by_cluster.items()]
    return assigned.join(F.broadcast(spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
