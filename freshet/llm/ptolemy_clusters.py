"""Centroid clustering with Ptolemaic pivots.

Lloyd's algorithm over vectors of whole numbers.  The initial centroids stay as
pivots: the distance of every vector to every pivot is computed once and stored
beside the vector.  For a vector x, a centroid c and a pair of pivots p, q,
Ptolemy's inequality gives

    d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q)

from cached numbers alone, whatever the dimension.  A round asks the centroid
with the least bound first, exactly; every other centroid whose bound is above
that distance is out, and the survivors are compared exactly, in 64-bit whole
numbers.  Bounds are rounded down by more than all rounding errors together and
a centroid at the same distance survives, so ties go to the smaller number just
as without pivots.

A round is one narrow pass.  Every task adds up its vectors by cluster and
gives one row per cluster and component, so no cluster, however large, meets
in one task, and the driver gets clusters x components numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import release_scratch, written
from .vectors import floor_mean, usable, whole_numbers

CLUSTERS, ROUNDS, SCALE, DIMENSION, SEED = 8, 10, 1024, 64, 3
#: Vectors that a task holds as numbers of 64 bits at once.
AT_ONCE = 1 << 12
#: More than the relative error of a bound: a few operations of 2 ** -53 each.
MARGIN = 2.0 ** -40

Centroids = list[list[int]]


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances, in whole numbers."""
    return ((x - centroid) ** 2).sum(axis=1)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(x, p) for p in pivots], axis=1).astype(np.float64))


@dataclass
class Pivots:
    """Fixed pivots and the pairs whose bounds are taken."""
    points: np.ndarray
    pairs: list[tuple[int, int]]

    @classmethod
    def of(cls, points: Centroids, dimension: int) -> Pivots:
        """Each pivot with the two that follow it, in a ring."""
        n = len(points)
        ring = {tuple(sorted((i, (i + step) % n))) for i in range(n) for step in (1, 2)}
        at = np.array(points, dtype=np.int64).reshape(n, dimension)
        return cls(at, sorted((a, b) for a, b in ring if a != b and (at[a] != at[b]).any()))

    def bounds(self, cached: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances, one row per vector and one column per centroid, never above the true one."""
        out = np.zeros((len(cached), len(centroids)))
        between, own = pivot_distances(self.points, self.points), pivot_distances(centroids, self.points)
        for p, q in self.pairs:
            for c in range(len(centroids)):
                one, other = cached[:, p] * own[c, q], cached[:, q] * own[c, p]
                np.maximum(out[:, c], (np.abs(one - other) - (one + other) * MARGIN) / between[p, q], out=out[:, c])
        return out * (1 - MARGIN)

    def nearest(self, x: np.ndarray, cached: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid, squared distance, and how many distances had to be computed."""
        bounds = self.bounds(cached, centroids)
        cluster = bounds.argmin(axis=1)
        distance = ((x - centroids[cluster]) ** 2).sum(axis=1)
        first, computed = cluster.copy(), len(x)
        for c in range(len(centroids)):
            at = np.flatnonzero((first != c) & (bounds[:, c] ** 2 * (1 - MARGIN) <= distance))
            exact = squared(x[at], centroids[c])
            better = (exact < distance[at]) | ((exact == distance[at]) & (c < cluster[at]))
            cluster[at[better]], distance[at[better]] = c, exact[better]
            computed += len(at)
        return cluster, distance, computed


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def with_pivot_distances(vectors: DataFrame, pivots: Pivots) -> DataFrame:
    """``vectors`` with their distances to the pivots as ``cached``."""
    dimension = pivots.points.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(k, AT_ONCE)
                far = pivot_distances(_numbers(batch.column("q"), dimension).astype(np.int64), pivots.points)
                lists = pa.ListArray.from_arrays(np.arange(len(far) + 1, dtype=np.int32) * far.shape[1], far.ravel())
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "cached"])

    return vectors.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema) + ", cached array<double>")


def _blocks(batches: Iterator[pa.RecordBatch], pivots: Pivots) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for whole in batches:
        for k in range(0, whole.num_rows, AT_ONCE):
            batch = whole.slice(k, AT_ONCE)
            yield batch, _numbers(batch.column("q"), pivots.points.shape[1]).astype(np.int64), _numbers(batch.column("cached"), len(pivots.points))


def _task_sums(pivots: Pivots, centroids: Centroids) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sums of a task's vectors by cluster and component; component -1 counts the vectors, -2 the distances computed."""
    at = np.array(centroids, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(at), at.shape[1] + 2), dtype=np.int64)
        for _, x, cached in _blocks(batches, pivots):
            cluster, _, computed = pivots.nearest(x, cached, at)
            totals[0, -2] += computed
            for c in np.unique(cluster).tolist():
                own = x[cluster == c]
                totals[c, :-2] += own.sum(axis=0)
                totals[c, -1] += len(own)
        who, what = np.nonzero(totals)
        named = np.where(what < at.shape[1], what, what - totals.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(who, pa.int32()), pa.array(named, pa.int32()), pa.array(totals[who, what])], names=["cluster", "component", "total"])

    return run


def updated(vectors: DataFrame, pivots: Pivots, centroids: Centroids) -> tuple[Centroids, int]:
    """The centroids after one round, and how many distances it computed."""
    rows = vectors.select("q", "cached").mapInArrow(_task_sums(pivots, centroids), "cluster int, component int, total bigint")
    sums = {(r[0], r[1]): r[2] for r in rows.groupBy("cluster", "component").agg(F.sum("total")).collect()}  # clusters x components
    new = [list(c) for c in centroids]
    for c in range(len(centroids)):
        if count := sums.get((c, -1), 0):
            new[c] = [floor_mean(sums.get((c, i), 0), count) for i in range(len(centroids[c]))]
    return new, sums.get((0, -2), 0)


def assigned(vectors: DataFrame, pivots: Pivots, centroids: Centroids) -> DataFrame:
    """(vec_id, cluster, distance) under fixed centroids."""
    at = np.array(centroids, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x, cached in _blocks(batches, pivots):
            cluster, distance, _ = pivots.nearest(x, cached, at)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint")


@dataclass
class Clusters:
    rows: DataFrame  # vec_id, cluster, distance
    centroids: Centroids
    computed: list[int]  # distances computed by round

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids]


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, dimension: int = DIMENSION, seed: int = SEED,
            vec_id: str = "vec_id", vector: str = "embedding") -> Clusters:
    """Clusters of ``vectors`` after ``rounds`` rounds.

    Each component becomes floor(scale * x).  Centroids start as the vectors
    with the smallest sha256 of ``seed:id``, in that order; equal ids in the
    order of their vectors, NULL ids last.  Empty centroids stay.

    Rows whose vector is NULL, has another length than ``dimension`` or holds
    NULL or a non-finite component do not come back.  Repeated rows and ids
    each have their row.  With fewer vectors than clusters there are fewer
    centroids; without vectors none, and no rows.  Other columns are not read.
    """
    given = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("v"))
    kept = given.where(usable(F.col("v"), dimension)).select("vec_id", whole_numbers(F.col("v"), scale).alias("q"))
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(named.asc_nulls_last(), "q").select("q").limit(clusters).collect()
    centroids: Centroids = [list(r["q"]) for r in first]
    if not centroids:
        return Clusters(kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), [], [])
    pivots = Pivots.of(centroids, dimension)
    stored, path = written(with_pivot_distances(kept, pivots), "pivots")
    computed = []
    for _ in range(rounds):
        new, n = updated(stored, pivots, centroids)
        computed.append(n)
        if new == centroids:
            break  # nothing can change any more
        centroids = new
    rows, _ = written(assigned(stored, pivots, centroids), "clusters")
    release_scratch(vectors.sparkSession, [path])
    return Clusters(rows, centroids, computed)


def with_inertia(found: Clusters) -> DataFrame:
    """The rows with the distances summed over their cluster and over all, and their centroid's digest."""
    by_cluster = {r[0]: r[1] for r in found.rows.groupBy("cluster").agg(F.sum("distance")).collect()}  # one row per centroid
    digests = found.digests()
    own = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.array().cast(f"array<{kind}>"), F.col("cluster"))
    return found.rows.select(
        "vec_id", "cluster", "distance", own([by_cluster.get(c, 0) for c in range(len(digests))], "bigint").alias("cluster_inertia"),
        F.lit(sum(by_cluster.values())).cast("bigint").alias("inertia"), own(digests, "string").alias("centroid_sha256"))
