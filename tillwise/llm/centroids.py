"""Centroid clustering of integer vectors; the nearest centroid is found by a threshold algorithm.

In every dimension the centroids are sorted by value. A vector walks each list outward from its own
value; the centroids it meets are compared exactly, and the squared gaps at the frontier, summed over
the dimensions, bound the distance of all it has not met. It stops when that sum strictly exceeds the
best exact distance, so a centroid that might tie is still looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import land

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SEED = "2"
#: Vectors a task holds at a time.
BLOCK = 1024

Vector = Sequence[int]


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, x array<bigint>): floor(scale * component) of the vectors that are kept.

    Kept are those with exactly ``dimensions`` components, none null or non-finite. A component
    beyond the range of bigint is given as its nearest end.
    """
    value = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.where((F.size("embedding") == dimensions) & finite)
    return kept.select("vec_id", F.transform(value, lambda c: F.floor(c * float(scale))).alias("x"))


def first_centroids(whole: DataFrame, clusters: int = CLUSTERS, seed: str = SEED) -> list[list[int]]:
    """The vectors whose ids have the smallest digests, in that order; ties by id, then by vector."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = whole.orderBy(digest, "vec_id", "x").limit(clusters).collect()  # bounded by ``clusters``
    return [list(r["x"]) for r in rows]


class Lists:
    """The sorted centroid lists of all dimensions."""

    def __init__(self, centroids: Sequence[Vector], kind: type):
        self.rows = np.array(centroids, dtype=kind)
        self.order = np.argsort(self.rows, axis=0, kind="stable").T  # dimension, place -> centroid
        self.values = np.take_along_axis(self.rows, self.order.T, axis=0).T

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(centroid, squared distance, exact comparisons made) for every row of ``x``; ties go to the smaller number."""
        n, dims = x.shape
        k = len(self.rows)
        best = np.full(n, -1)
        least = np.zeros(n, dtype=x.dtype)
        met = np.zeros((n, k), dtype=bool)
        # places of the next centroid below and above a vector's value, in each dimension
        above = np.stack([np.searchsorted(self.values[d], x[:, d]) for d in range(dims)], axis=1)
        below = above - 1
        at = np.arange(dims)
        active = np.arange(n)
        for _ in range(k):
            low, high, here = below[active], above[active], x[active]
            down = here - self.values[at, np.maximum(low, 0)]
            up = self.values[at, np.minimum(high, k - 1)] - here
            lower = (low >= 0) & ((high >= k) | (down <= up))
            gap = np.where(lower, down, up)
            found = self.order[at, np.where(lower, low, high)]
            below[active] -= lower
            above[active] += ~lower
            new = np.zeros((len(active), k), dtype=bool)
            new[np.arange(len(active))[:, None], found] = True
            new &= ~met[active]
            met[active] |= new
            # ascending centroid numbers within a row, so the first minimum is the smaller one
            row, centroid = np.nonzero(new)
            exact = ((here[row] - self.rows[centroid]) ** 2).sum(axis=1)
            for c in np.unique(centroid):
                of = centroid == c
                rows, distance = active[row[of]], exact[of]
                better = (best[rows] < 0) | (distance < least[rows]) | ((distance == least[rows]) & (c < best[rows]))
                best[rows[better]], least[rows[better]] = c, distance[better]
            frontier = (gap**2).sum(axis=1)
            active = active[(frontier <= least[active]) & ~met[active].all(axis=1)]
            if not len(active):
                break
        return best, least, met.sum(axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], centroids: Sequence[Vector], dimensions: int):
    """(ids, vectors, centroid, squared distance) of every block of rows.

    Components whose squared distances fit 64 bits are handled by machine integers, blocks with others
    by Python's.
    """
    small = math.isqrt(((1 << 63) - 1) // dimensions) // 2
    large = any(abs(v) > small for c in centroids for v in c)
    lists = {kind: Lists(centroids, kind) for kind in ((object,) if large else (np.int64, object))}
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            x = part.column("x").flatten().to_numpy().reshape(-1, dimensions)
            kind = object if large or (x > small).any() or (x < -small).any() else np.int64
            x = x.astype(kind)
            yield part.column("vec_id"), x, *lists[kind].nearest(x)[:2]


def assign(whole: DataFrame, centroids: Sequence[Vector], dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, cluster int, distance bigint) of every vector; a distance beyond bigint is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance in _blocks(batches, centroids, dimensions):
            fits = [d if d < 1 << 63 else None for d in distance.tolist()]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster, pa.int32()), pa.array(fits, pa.int64())], names=["vec_id", "cluster", "distance"]
            )

    vec_id = whole.schema["vec_id"].dataType.simpleString()
    return whole.mapInArrow(run, f"vec_id {vec_id}, cluster int, distance bigint")


def move(whole: DataFrame, centroids: list[list[int]], dimensions: int = DIMENSIONS) -> list[list[int]]:
    """The floor of the mean of each centroid's vectors; a centroid without any stays.

    Each task hands on one row for each centroid and dimension, whatever its share of the vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centroids), dimensions), dtype=object)
        counts = np.zeros(len(centroids), dtype=np.int64)
        for _, x, cluster, _ in _blocks(batches, centroids, dimensions):
            for c in np.unique(cluster):
                of = x[cluster == c]
                sums[c] += of.sum(axis=0).astype(object)
                counts[c] += len(of)
        used = np.flatnonzero(counts)
        totals = [int(v) for v in sums[used].ravel()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, dimensions), pa.int32()),
                pa.array(np.tile(np.arange(dimensions), len(used)), pa.int32()),
                pa.array(totals, pa.decimal128(38)),
                pa.array(np.repeat(counts[used], dimensions), pa.int64()),
            ],
            names=["cluster", "dimension", "total", "n"],
        )

    partial = whole.mapInArrow(run, "cluster int, dimension int, total decimal(38,0), n bigint")
    sums = partial.groupBy("cluster", "dimension").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    moved = [list(c) for c in centroids]
    for r in sums.collect():  # clusters * dimensions rows
        moved[r["cluster"]][r["dimension"]] = int(r["total"]) // r["n"]
    return moved


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: str = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every kept row of ``vectors`` (vec_id, embedding), and the centroids.

    ``rounds`` times every vector goes to its nearest centroid (squared Euclidean distance, ties to the
    smaller number) and every centroid that has vectors to the floor of their mean; then vectors are
    assigned once more. See ``whole_vectors`` for what is kept and ``first_centroids`` for the start.
    Repeated rows count and return each on its own; fewer vectors than ``clusters`` give as many
    clusters; no vectors give no rows; other columns are ignored. Arithmetic is in integers of any
    size; a distance beyond bigint is returned as null. The driver holds the centroids only.
    """
    whole = whole_vectors(vectors, dimensions, scale)
    centroids = first_centroids(whole, clusters, seed)
    if not centroids:
        return whole.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), []
    for _ in range(rounds):
        centroids = move(whole, centroids, dimensions)
    return assign(whole, centroids, dimensions), centroids


def with_totals(assigned: DataFrame, centroids: Sequence[Vector]) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia (distance summed over the cluster and over all
    vectors, null if beyond bigint) and centroid_sha256. Assignments are landed and read twice."""
    spark = assigned.sparkSession
    assigned = land(assigned)
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = assigned.groupBy("cluster").agg(exact.alias("own"), F.count_if(F.col("distance").isNull()).alias("lost"))
    totals = {r["cluster"]: None if r["lost"] else int(r["own"]) for r in sums.collect()}  # a row a cluster
    everything = None if None in totals.values() else sum(totals.values())
    fits = lambda n: n if n is not None and n < 1 << 63 else None
    rows = [
        (c, fits(total), fits(everything), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for c, total in totals.items()
    ]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
