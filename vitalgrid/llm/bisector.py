"""Centroid clustering of integer vectors, assigned by a tournament of bisectors.

For centroids ``i < j`` the plane halfway between them has an integer normal ``2 (c_j - c_i)`` and an integer
threshold ``|c_j|^2 - |c_i|^2``. Both are computed once a round for all pairs. A vector's tournament starts
with centroid 0; each of the ``k - 1`` others meets the winner so far in one linear test, and the sign of
``normal . x - threshold`` tells which one loses: above zero the newcomer wins, at zero the smaller number.
Only the last winner's distance is computed. All numbers are integers, so the result is exact.

A round sends at most ``k`` partial sums from each task; centroids, normals and thresholds are a few
thousand numbers that go out with the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import stored

DIMENSIONS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
#: components are below this in size, so that squared distances and the tests fit 64 bits
LARGEST = 2 ** 26
SLICE = 8192


def usable(vector: str, dimensions: int = DIMENSIONS) -> Column:
    """Whether an array of floats has exactly so many components, none of them null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def quantized(vectors: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    """Rows of ``floor(scale * x)``, computed in doubles."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
    whole = np.floor(values * scale)
    if whole.size and np.abs(whole).max() >= LARGEST:
        raise ValueError(f"a component times {scale} reaches {LARGEST}: its squared distances do not fit 64 bits")
    return whole.astype(np.int64)


@dataclass(frozen=True)
class Bisectors:
    """Normals and thresholds of all pairs of centroids."""

    centroids: np.ndarray  # k rows
    normals: np.ndarray  # [i, j]: of the plane between i and j
    thresholds: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> Bisectors:
        size = (centroids * centroids).sum(1)
        return cls(centroids, 2 * (centroids[None] - centroids[:, None]), size[None] - size[:, None])

    def winners(self, rows: np.ndarray) -> np.ndarray:
        """The nearest centroid of each row, of equals the smallest number."""
        best = np.zeros(len(rows), np.int64)
        for j in range(1, len(self.centroids)):
            # rows are taken by the winner they have, so that each pair of centroids is one product
            for i in np.unique(best):
                held = np.flatnonzero(best == i)
                best[held[rows[held] @ self.normals[i, j] > self.thresholds[i, j]]] = j
        return best

    def distances(self, rows: np.ndarray, winners: np.ndarray) -> np.ndarray:
        apart = rows - self.centroids[winners]
        return (apart * apart).sum(1)


def _slices(batches: Iterator[pa.RecordBatch], dimensions: int, scale: int):
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield part, quantized(part.column(part.num_columns - 1), dimensions, scale)


def _partial_sums(batches, bisectors: Bisectors, dimensions: int, scale: int) -> Iterator[pa.RecordBatch]:
    """One row for each cluster of the task: its vectors' number and componentwise sums."""
    k = len(bisectors.centroids)
    number, total = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
    for _, rows in _slices(batches, dimensions, scale):
        best = bisectors.winners(rows)
        for i in np.unique(best):
            held = rows[best == i]
            number[i] += len(held)
            total[i] += held.sum(0)
    seen = np.flatnonzero(number)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(number[seen]),
         *[pa.array(np.ascontiguousarray(total[seen, d])) for d in range(dimensions)]],
        names=["cluster", "n", *[f"s{d}" for d in range(dimensions)]])


def _assigned(batches, bisectors: Bisectors, dimensions: int, scale: int) -> Iterator[pa.RecordBatch]:
    for part, rows in _slices(batches, dimensions, scale):
        best = bisectors.winners(rows)
        yield pa.RecordBatch.from_arrays(
            [*part.columns[:-1], pa.array(best.astype(np.int32)), pa.array(bisectors.distances(rows, best))],
            names=[*part.schema.names[:-1], "cluster", "distance"])


def first_centroids(kept: DataFrame, number: int, dimensions: int, scale: int) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, which come to the driver: ``number`` rows.

    Of equal ids the smaller vector comes first; a null id is hashed as empty.
    """
    hashed = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select("vector", hashed.alias("hash")).orderBy("hash", "vector").limit(number).collect()
    vectors = pa.array([r["vector"] for r in rows], pa.list_(pa.float64()))
    return quantized(vectors, dimensions, scale)


def moved(kept: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """The centroids after one round: the floor of each cluster's mean; empty clusters stay."""
    dimensions, bisectors = centroids.shape[1], Bisectors.of(centroids)
    names = [f"s{d}" for d in range(dimensions)]
    parts = kept.select("vector").mapInArrow(
        lambda batches: _partial_sums(batches, bisectors, dimensions, scale),
        "cluster int, n long, " + ", ".join(f"{c} long" for c in names))
    sums = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(30,0)")).alias(c) for c in names]).collect()
    after = centroids.copy()
    for row in sums:  # k rows
        after[row["cluster"]] = [int(row[c]) // row["n"] for c in names]
    return after


def cluster_vectors(
    vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
    scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of every usable vector, and the final centroids, one row each.

    Vectors of another length, and those with null, infinite or NaN components, are left out, null vectors too.
    The others become integers ``floor(scale * x)``. With fewer usable vectors than ``centroids`` each is a
    centroid; without any there are no rows. Null and repeated ids and repeated vectors are rows of
    their own. Equal centroids may occur; the smaller number then takes all. Other columns are ignored.
    Raises ``ValueError`` (in the job) for a component of ``LARGEST`` or more after scaling. The input is read once a
    round and once for the assignment.
    """
    chosen = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    kept = chosen.where(usable("vector", dimensions))
    now = first_centroids(kept, centroids, dimensions, scale)
    for _ in range(rounds if len(now) else 0):
        now = moved(kept, now, scale)
    bisectors = Bisectors.of(now)
    assigned = kept.mapInArrow(
        lambda batches: _assigned(batches, bisectors, dimensions, scale),
        f"vec_id {dict(chosen.dtypes)['vec_id']}, cluster int, distance long")
    return assigned, now


def clustered(vectors: DataFrame) -> DataFrame:
    """Every vector with its cluster, the cluster's and the whole inertia, and a digest of its centroid."""
    assigned, centroids = cluster_vectors(vectors)
    assigned = stored(assigned, "clustered-vectors")
    inertia = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    whole = sum(inertia.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = assigned.sparkSession.createDataFrame(
        [(i, d, whole, digests[i]) for i, d in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row a cluster, so at most as many as centroids
    return assigned.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
