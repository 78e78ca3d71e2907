"""Centroid clustering of embeddings with Orchard's search for the nearest centroid."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Scaled components beyond this are set to it; distances then stay far inside a long.
COMPONENT_LIMIT = 1 << 23
#: Entries of the table of visited centroids that a task keeps at a time.
VISITED = 1 << 24


def neighbour_lists(centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid all centroids by growing distance (itself first), and those squared distances."""
    gaps = np.stack([((centres - c) ** 2).sum(axis=1) for c in centres])
    np.fill_diagonal(gaps, -1)  # a centroid leads its own list even where another equals it
    order = np.argsort(gaps, axis=1, kind="stable")
    return order, np.take_along_axis(np.maximum(gaps, 0), order, axis=1)


def nearest(points: np.ndarray, centres: np.ndarray, order: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid of each point; ties go to the smaller number.

    Every point walks the list of its current centroid. A closer centroid becomes the current one
    and its list is walked from the start; centroids looked at once are marked and passed over. A
    walk stops where the list's distance is strictly beyond twice the point's: by the triangle
    inequality nothing from there on is as near, not even equally near. All points of a block
    take their steps together.
    """
    n, k = len(points), len(centres)
    current = np.zeros(n, np.int64)
    best = ((points - centres[0]) ** 2).sum(axis=1)
    place = np.ones(n, np.int64)
    visited = np.zeros((n, k), bool)
    visited[:, 0] = True
    walking = np.arange(n)
    while True:
        walking = walking[place[walking] < k]
        walking = walking[gaps[current[walking], place[walking]] <= 4 * best[walking]]
        if not len(walking):
            return current, best
        other = order[current[walking], place[walking]]
        place[walking] += 1
        new = ~visited[walking, other]
        at, other = walking[new], other[new]
        visited[at, other] = True
        far = ((points[at] - centres[other]) ** 2).sum(axis=1)
        nearer = (far < best[at]) | ((far == best[at]) & (other < current[at]))
        at, other = at[nearer], other[nearer]
        current[at], best[at], place[at] = other, far[nearer], 1


def _assigned(batch: pa.RecordBatch, centres: np.ndarray, order: np.ndarray, gaps: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, points, clusters and distances of each block of a batch with a column ``x``."""
    points = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, centres.shape[1])
    step = max(1, VISITED // max(len(centres), points.shape[1]))
    for at in range(0, len(points), step):
        block = points[at : at + step]
        yield at, block, *nearest(block, centres, order, gaps)


def scaled(embedding: Column, scale: int = 1024) -> Column:
    """Components as integers, ``floor(scale * x)`` in double precision, held to ``COMPONENT_LIMIT``."""
    low, high = F.lit(float(-COMPONENT_LIMIT)), F.lit(float(COMPONENT_LIMIT))
    return F.transform(embedding, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, low), high)).cast("int"))


def usable(embedding: Column, dims: int) -> Column:
    """Whether a vector has exactly ``dims`` components, none of them NULL or not finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce((F.size(embedding) == dims) & F.forall(embedding, finite), F.lit(False))


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    seed: int = 3,
    scale: int = 1024,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id``, ``cluster``, ``distance`` (squared) of every usable vector, and the final centroids.

    Vectors are integers (``scaled``), so sums and distances are exact and every run agrees. The
    first centroids are the ``k`` vectors with the smallest ``sha256(seed:vec_id)``; a round assigns
    every vector to the nearest and puts each centroid at the floor of its vectors' mean. Tasks
    add up their own vectors: a round moves ``k * dims`` sums per task and nothing else, however
    unequal the clusters are. The driver holds the centroids and their ``k * k`` neighbour lists.

    Vectors that are NULL, of another length, or with a NULL or non-finite component are left out.
    Repeated rows count as often as they come. A row without an id is clustered but is no first
    centroid; among rows with the same id the componentwise smallest is. With fewer than ``k`` rows with
    an id there are as many centroids as there are such rows, without any the result is empty.
    Centroids without vectors stay where they are. Other columns do not matter.
    """
    kept = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("e")).where(usable(F.col("e"), dims))
    points = written(kept.select("vec_id", scaled(F.col("e"), scale).alias("x")), "orchard-points")
    ranked = points.where("vec_id is not null").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    first = ranked.orderBy("h", "x").limit(k).collect()
    if not first:
        return points.where(F.lit(False)).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    centres = np.array([r["x"] for r in first], np.int64).reshape(len(first), dims)

    for _ in range(rounds):
        order, gaps = neighbour_lists(centres)

        def add(batches: Iterator[pa.RecordBatch], centres=centres, order=order, gaps=gaps) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros_like(centres), np.zeros(len(centres), np.int64)
            for batch in batches:
                for _, block, own, _ in _assigned(batch, centres, order, gaps):
                    counts += np.bincount(own, minlength=len(centres))
                    np.add.at(sums, own, block)
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({
                "cluster": pa.array(np.repeat(used, dims), pa.int32()), "place": pa.array(np.tile(np.arange(dims), len(used)), pa.int32()),
                "total": pa.array(sums[used].ravel(), pa.int64()), "n": pa.array(np.repeat(counts[used], dims), pa.int64()),
            })

        sums = points.select("x").mapInArrow(add, "cluster int, place int, total long, n long")
        moved = centres.copy()
        for r in sums.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            moved[r["cluster"], r["place"]] = r["total"] // r["n"]
        centres = moved

    order, gaps = neighbour_lists(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block, own, far in _assigned(batch, centres, order, gaps):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").slice(at, len(block)), pa.array(own, pa.int32()), pa.array(far, pa.int64())], ["vec_id", "cluster", "distance"]
                )

    id_type = points.schema["vec_id"].dataType.simpleString()
    found = points.mapInArrow(assign, f"vec_id {id_type}, cluster int, distance long")
    return written(found, "orchard-clusters"), centres.tolist()


def with_inertia(clustered: DataFrame) -> DataFrame:
    """``clustered`` with ``cluster_inertia`` and ``inertia``, the distances summed over each cluster and over all.

    Sums are exact and, should they not fit, the largest long.
    """
    fitting = lambda c: F.least(c, F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    sums = clustered.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("own"))
    whole = F.sum("own").over(Window.partitionBy(F.lit(0)))  # one row per centroid
    sums = sums.select("cluster", fitting(F.col("own")).alias("cluster_inertia"), fitting(whole).alias("inertia"))
    return clustered.join(F.broadcast(sums), "cluster")
