"""Centroid clustering with exact integers: nearest centroids by a tournament of bisectors.

Vectors become integers, floor(``SCALE`` * component). For every pair of centroids a < b the bisector is
kept as an integer normal 2 (b - a) and the threshold |b|^2 - |a|^2: a vector lies nearer to b
where normal . vector - threshold is positive. A vector starts with centroid 0 and meets 1, 2, ..., k - 1 in
turn; each of the k - 1 linear tests leaves one of the two, and zero leaves the smaller number. The
squared distance is then computed once, for the centroid that is left. Products run in doubles where
they are exact below 2**53, else in 64-bit integers; both give the same numbers.

The first centroids are the vectors with the smallest sha256 of ``1:<vec_id>``. A round assigns every vector
and replaces each centroid by the floor of its vectors' mean, an empty one stays. Tasks add up their
vectors by centroid before anything is sent, so a centroid that holds a third of all vectors costs no more
than another; only k sums reach the driver. The centroids, k times 64 numbers, travel with the function.

Defined results: vectors that are null, have another length, or hold null or non-finite components take
no part. Fewer vectors than k make fewer centroids; an empty table has no rows. Equal centroids
lose to the smaller number. A null vec_id hashes as the text ``null``; rows that repeat a vec_id are vectors of
their own, ordered by their components where the hash ties. Components of 2**LIMIT and more
after scaling raise an error, since their distances need not fit 64 bits. Other columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_batch, written

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
# Distances of 64 components stay below 2**62.
LIMIT = 27


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and the integer vector of every row that takes part."""
    # Beyond this the cast below would fail without saying why.
    most = (2.0**LIMIT - 1) / scale
    usual = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    floored = F.transform("_v", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    too_large = F.raise_error(F.lit(f"a component is 2**{LIMIT} or more after scaling: too large for exact distances"))
    return (
        vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("_v"))
        .where((F.size("_v") == dimensions) & usual)
        .select("vec_id", F.when(F.forall("_v", lambda x: F.abs(x) < F.lit(most)), floored).otherwise(too_large).alias("v"))
    )


def first_centroids(whole: DataFrame, k: int) -> np.ndarray:
    """The k vectors with the smallest hashes, in the order of these."""
    named = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    rows = whole.select(named.alias("hash"), "v").orderBy("hash", "v").limit(k).collect()
    return np.array([row.v for row in rows], np.int64).reshape(len(rows), len(rows[0].v) if rows else 1)


class Bisectors:
    """Normals and thresholds of all pairs of centroids, and the tournament over them."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        squares = (centroids**2).sum(axis=1)
        # Entry (a, b) with a < b is the bisector between them.
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]
        self.largest = int(np.abs(self.normals).max(initial=0))
        self.in_doubles = self.normals.astype(np.float64)

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each vector and its squared distance."""
        winner = np.zeros(len(v), np.int64)
        exact = len(v) and int(np.abs(v).max()) * self.largest * v.shape[1] < 1 << 53
        normals = self.in_doubles if exact else self.normals
        rows = v.astype(np.float64) if exact else v
        for b in range(1, len(self.centroids)):
            # Vectors that share their present winner share the bisector.
            for a in np.unique(winner).tolist():
                mine = np.flatnonzero(winner == a)
                side = rows[mine] @ normals[a, b] - self.thresholds[a, b]
                winner[mine[side > 0]] = b
        return winner, ((v - self.centroids[winner]) ** 2).sum(axis=1)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def moved(whole: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    bisectors, dimensions = Bisectors(centroids), centroids.shape[1]

    def add_up(batch: pa.RecordBatch):
        v = _matrix(batch.column(0), dimensions)
        winner, _ = bisectors.nearest(v)
        order = np.argsort(winner, kind="stable")
        held, first = np.unique(winner[order], return_index=True)
        if not len(held):
            return None
        return {"cluster": held, "n": np.diff([*first, len(v)]), "sums": np.add.reduceat(v[order], first, axis=0).tolist()}

    parts = by_batch(whole.select("v"), add_up, "cluster int, n long, sums array<long>")
    # One row a centroid and component; a sum may exceed 64 bits on its way to the mean.
    total = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at")
    total = total.agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("whole"))
    after = centroids.copy()
    for row in total.collect():
        after[row.cluster, row["at"]] = int(row.whole) // row.n
    return after


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, **columns) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part."""
    whole = written(whole_vectors(vectors, **columns), "vectors")
    centroids = first_centroids(whole, k)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(whole, centroids)
    bisectors = Bisectors(centroids)
    dimensions = centroids.shape[1]

    def assign(batch: pa.RecordBatch):
        if not batch.num_rows:
            return None
        winner, distance = bisectors.nearest(_matrix(batch.column(1), dimensions))
        return {"vec_id": batch.column(0), "cluster": winner, "distance": distance}

    assigned = written(by_batch(whole, assign, "vec_id long, cluster int, distance long"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # At most k rows: one a cluster, with what its vectors are told.
    held = [(r.cluster, int(r.own), digests[r.cluster]) for r in sums.collect()]
    total = sum(own for _, own, _ in held)
    told = assigned.sparkSession.createDataFrame(
        [(c, own, total, digest) for c, own, digest in held], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return assigned.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
