"""Centroid clustering (operator 11): exact integer k-means whose comparisons are filtered by n-simplex projection.

The distances of every vector to a few pivots are found once and stored with it. They fix the vector's apex over the simplex
that the pivots span: coordinates inside the pivots' plane, and an altitude above it. Two apexes bound the distance of their
points from below (altitudes on one side) and above (altitudes on opposite sides). In each round the centroids get
apexes too; a centroid whose lower bound is beyond another's upper bound can't be nearest, and only those left are compared
exactly, on all components. So the bounds save work and never decide.

A round is one job: tasks read their share of the stored vectors, and each gives one row of counts and sums for a
centroid; only centroids (``clusters`` times ``dimensions`` integers) pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.scratch import dropped, saved

#: Integer components beyond this are left out: squared distances of 64 components then fit 64 bits.
LARGEST = 1 << 27
#: Rows that a task compares at a time.
_BLOCK = 4096
#: A base of pivots worse than this is not extended; rounding errors of coordinates stay below 1e-11 of the lengths.
_WORST_BASE = 1e4
#: Share of the lengths by which bounds are widened: an altitude is the root of a difference, so it loses half the digits.
_SLACK = 1e-5


@dataclass(frozen=True)
class Settings:
    """``clusters`` centroids, ``rounds`` updates; components are floor(``scale`` * x). ``seed`` picks the starts, ``pivots`` is the most pivots."""

    clusters: int = 16
    rounds: int = 3
    dimensions: int = 64
    scale: int = 64
    seed: int = 1
    pivots: int = 16


class Simplex:
    """The simplex of the pivots (integer rows): apexes of points from their squared distances to the pivots."""

    def __init__(self, pivots: np.ndarray):
        edges = (pivots[1:] - pivots[0]).astype(float)
        self.size = (edges * edges).sum(axis=1)
        low = np.linalg.cholesky(edges @ edges.T) if len(edges) else np.zeros((0, 0))
        self.inverse = np.linalg.inv(low).T
        self.reach = float(np.sqrt(self.size.max(initial=0.0)))

    def apexes(self, squared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Coordinates in the pivots' plane, altitude above it, and how far either may be off, for each row of squared distances."""
        squared = squared.astype(float)
        flat = ((squared[:, :1] - squared[:, 1:] + self.size) / 2) @ self.inverse
        altitude = np.sqrt(np.maximum(squared[:, 0] - (flat * flat).sum(axis=1), 0.0))
        return flat, altitude, _SLACK * (np.sqrt(squared[:, 0]) + self.reach) + 1e-6


def choose_pivots(points: np.ndarray, most: int) -> np.ndarray:
    """The first of the points (integer rows), then further ones in order while the simplex stays well shaped."""
    chosen = points[:1]
    for point in points[1:]:
        if len(chosen) >= most:
            break
        longer = np.vstack([chosen, point])
        edges = (longer[1:] - longer[0]).astype(float)
        if np.linalg.cond(edges @ edges.T) < _WORST_BASE**2:
            chosen = longer
    return chosen


def squared_distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances (64-bit) of all points to each of a few others."""
    out = np.empty((len(points), len(others)), np.int64)
    for j, other in enumerate(others):
        gap = points - other
        out[:, j] = np.einsum("ij,ij->i", gap, gap)
    return out


class Nearest:
    """The nearest centroid of points with stored pivot distances; ``compared`` counts exact comparisons."""

    def __init__(self, pivots: np.ndarray, centroids: np.ndarray):
        self.simplex, self.centroids, self.compared = Simplex(pivots), centroids, 0
        self.flat, self.altitude, self.off = self.simplex.apexes(squared_distances(centroids, pivots))

    def __call__(self, points: np.ndarray, squared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and exact squared distance of each point's nearest centroid; of equally near ones the smaller number."""
        flat, altitude, off = self.simplex.apexes(squared)
        plane = ((flat[:, None, :] - self.flat) ** 2).sum(axis=2)
        slack = off[:, None] + self.off
        lower = np.sqrt(plane + (altitude[:, None] - self.altitude) ** 2) - slack
        upper = np.sqrt(plane + (altitude[:, None] + self.altitude) ** 2) + slack
        possible = lower <= upper.min(axis=1, keepdims=True)
        number, best = np.zeros(len(points), np.int32), np.full(len(points), np.iinfo(np.int64).max)
        for c, centroid in enumerate(self.centroids):
            rows = np.flatnonzero(possible[:, c])
            gap = points[rows] - centroid
            exact = np.einsum("ij,ij->i", gap, gap)
            self.compared += len(rows)
            closer = exact < best[rows]
            number[rows[closer]], best[rows[closer]] = c, exact[closer]
        return number, best


def integer_vectors(vectors: DataFrame, s: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id`` and ``point`` (integer components) of the vectors with exactly ``dimensions`` finite components."""
    x = F.col(f"`{vector_col}`")
    most = LARGEST // s.scale
    usable = (F.size(x) == s.dimensions) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= most))
    point = F.transform(x, lambda v: F.floor(v.cast("double") * s.scale).cast("int"))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(f"`{id_col}`").alias("id"), point.alias("point"))


def first_centroids(points: DataFrame, s: Settings) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in order; of repeated ids the smaller vector is first. At most ``clusters`` rows are fetched."""
    order = F.sha2(F.concat(F.lit(f"{s.seed}:"), F.col("id").cast("string")), 256)
    rows = points.where("id is not null").select(order.alias("order"), "point").orderBy("order", "point").limit(s.clusters).collect()
    return np.array([r["point"] for r in rows], np.int64).reshape(len(rows), s.dimensions)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), width)


def with_pivot_distances(points: DataFrame, pivots: np.ndarray, s: Settings) -> DataFrame:
    """The points with ``squared``, their squared distances to the pivots: all that later rounds need for bounds."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = squared_distances(_matrix(batch.column(1), s.dimensions), pivots)
            border = np.arange(len(found) + 1, dtype=np.int32) * len(pivots)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(border), pa.array(found.ravel()))], ["id", "point", "squared"])

    return points.mapInArrow(measure, f"id {points.schema['id'].dataType.simpleString()}, point array<int>, squared array<long>")


def _blocks(batches: Iterator[pa.RecordBatch], nearest: Nearest, s: Settings, m: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for whole in batches:
        for first in range(0, whole.num_rows, _BLOCK):
            batch = whole.slice(first, _BLOCK)
            points = _matrix(batch.column(1), s.dimensions)
            yield batch, points, *nearest(points, _matrix(batch.column(2), m))


def updated(stored: DataFrame, pivots: np.ndarray, centroids: np.ndarray, s: Settings) -> np.ndarray:
    """The centroids after one round: the floored means of their vectors; one without vectors stays."""
    k = len(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, s.dimensions), np.int64)
        for _, points, number, _ in _blocks(batches, Nearest(pivots, centroids), s, len(pivots)):
            count += np.bincount(number, minlength=k)
            order = np.argsort(number, kind="stable")
            own, at = np.unique(number[order], return_index=True)
            total[own] += np.add.reduceat(points[order], at, axis=0)
        border = np.arange(k + 1, dtype=np.int32) * s.dimensions
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(count), pa.ListArray.from_arrays(pa.array(border), pa.array(total.ravel()))], ["cluster", "n", "total"])

    sums = stored.mapInArrow(add, "cluster int, n long, total array<long>").groupBy("cluster")
    after = centroids.copy()
    for row in sums.agg(F.sum("n"), *[F.sum(F.get("total", F.lit(i))) for i in range(s.dimensions)]).collect():  # a row a centroid
        if row[1]:
            after[row[0]] = [x // row[1] for x in row[2:]]
    return after


def clusters(vectors: DataFrame, s: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Every usable vector's id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    Vectors with another number of components, or a null, infinite or NaN one, are left out, as are those with an integer
    component beyond 2 ** 27, whose squared distances don't fit 64 bits. Fewer usable vectors than clusters give
    fewer clusters; an empty table gives an empty table. Repeated rows all count and all come back; of equally near
    centroids the smaller number wins; a null id stays null and never starts a centroid (without any other, there is no
    cluster and no row). An inertia beyond 64 bits is null. Other columns are left out, whatever their names.
    """
    spark = vectors.sparkSession
    points = integer_vectors(vectors, s, id_col, vector_col)
    kind = points.schema["id"].dataType.simpleString()
    centroids = first_centroids(points, s)
    if not len(centroids):
        none = points.limit(0).select(F.col("id").alias(id_col), F.lit(0).alias("cluster"))
        return none.withColumns({c: F.lit(0).cast("long") for c in ("distance", "cluster_inertia", "inertia")}).withColumn("centroid_sha256", F.lit(""))
    pivots = choose_pivots(centroids, s.pivots)
    stored = saved(with_pivot_distances(points, pivots, s), "vectors")
    for _ in range(s.rounds):
        centroids = updated(stored, pivots, centroids, s)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, number, best in _blocks(batches, Nearest(pivots, centroids), s, len(pivots)):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number), pa.array(best)], ["id", "cluster", "distance"])

    assigned = saved(stored.mapInArrow(assign, f"id {kind}, cluster int, distance long"), "assigned")
    dropped(stored)
    inertia = {r[0]: r[1] for r in assigned.groupBy("cluster").agg(F.try_sum("distance")).collect()}  # a row a cluster
    fits = lambda n: n if n is not None and n < 1 << 63 else None
    total = None if None in inertia.values() else fits(sum(inertia.values()))
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    info = spark.createDataFrame([(c, inertia.get(c, 0), total, digest[c]) for c in range(len(centroids))], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row a centroid.
    done = assigned.join(F.broadcast(info), "cluster")
    return done.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
