"""Centroid clustering by equal-average equal-variance search, exact in integers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import bounded_batches, stored

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SALT = 1
FOUND = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def most(dimensions: int) -> int:
    """The largest component whose squared distances, times the dimensions, stay in 64 bits."""
    return (1 << 30) // dimensions


class Centroids:
    """Centroids in the order of their component sums, to be searched outwards from a vector's own sum.

    With S a sum of d components and Q = d * (sum of squares) - S * S, every pair
    obeys d * distance >= (Sx - Sc)^2 >= 0, the equal-average inequality, and
    d * distance >= (Sx - Sc)^2 + (sqrt(Qx) - sqrt(Qc))^2, the equal-variance one.
    The first ends a vector's search, the second skips a centroid. Sums and
    distances are integers; the roots are floats and get a margin, so that no
    centroid at the same distance is ever skipped.
    """

    def __init__(self, centroids: np.ndarray) -> None:
        sums, roots = self._signs(centroids)
        self.number = np.lexsort((np.arange(len(sums)), sums))
        self.rows, self.sums, self.roots = centroids[self.number], sums[self.number], roots[self.number]

    @staticmethod
    def _signs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = x.sum(axis=1)
        return sums, np.sqrt((x.shape[1] * np.einsum("ij,ij->i", x, x) - sums * sums).astype(np.float64))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest centroid of each row; ties go to the smaller number."""
        n, d = x.shape
        k = len(self.rows)
        sums, roots = self._signs(x)
        found = np.full(n, k, np.int64)
        best = np.full(n, (1 << 62) // d, np.int64)
        above = np.searchsorted(self.sums, sums)
        below = above - 1
        none = np.int64(1 << 31)
        active = np.arange(n)
        while len(active):
            lo, hi = below[active], above[active]
            down = np.where(lo >= 0, sums[active] - self.sums[lo], none)
            up = np.where(hi < k, self.sums[np.minimum(hi, k - 1)] - sums[active], none)
            down_first = down <= up
            gap = np.where(down_first, down, up)
            open_ = (gap < none) & (gap * gap <= d * best[active])
            active, at, gap = active[open_], np.where(down_first, lo, hi)[open_], gap[open_]
            down_first = down_first[open_]
            below[active[down_first]] -= 1
            above[active[~down_first]] += 1
            apart = np.abs(roots[active] - self.roots[at]) - 1e-9 * (1 + roots[active] + self.roots[at])
            bound = (gap * gap).astype(np.float64) + np.maximum(apart, 0.0) ** 2
            close = bound <= d * best[active].astype(np.float64) * (1 + 1e-9)
            row, at = active[close], at[close]
            step = x[row] - self.rows[at]
            distance, number = np.einsum("ij,ij->i", step, step), self.number[at]
            better = (distance < best[row]) | ((distance == best[row]) & (number < found[row]))
            row = row[better]
            best[row], found[row] = distance[better], number[better]
        return found, best


def grid(vectors: DataFrame, id_column: str, vector: str, dimensions: int, scale: int) -> DataFrame:
    """``vec_id`` and the integers ``x`` of the vectors that have every component, all finite."""

    def finite(x: Column) -> Column:
        value = x.cast("double")
        return x.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))

    whole = (F.size(vector) == dimensions) & F.forall(vector, finite)
    steps = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return vectors.filter(whole).select(F.col(id_column).cast("long").alias("vec_id"), steps.alias("x"))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)
    if len(x) and max(-int(x.min()), int(x.max())) > most(dimensions):
        raise ValueError(f"components beyond {most(dimensions)} steps have distances beyond 64 bits")
    return x


def _sums(kept: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many vectors each centroid has, and their component sums: one row per task and cluster is shuffled."""
    k, d = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, d), np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            cluster, _ = search.nearest(x)
            count += np.bincount(cluster, minlength=k)
            np.add.at(total, cluster, x)
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict(
            {"cluster": pa.array(own, pa.int32()), "n": pa.array(count[own], pa.int64()), "total": pa.array(list(total[own]), pa.list_(pa.int64()))}
        )

    found = kept.mapInArrow(partial, "cluster int, n long, total array<long>")
    counts, totals = np.zeros(k, object), np.zeros((k, d), object)
    summed = found.select("cluster", "n", F.posexplode("total").alias("i", "part")).groupBy("cluster", "i")
    # As many rows as the centroids have components.
    for cluster, i, n, total in summed.agg(F.sum("n"), F.sum(F.col("part").cast("decimal(38,0)"))).collect():
        counts[cluster], totals[cluster, i] = n, int(total)
    return counts, totals


def clustered(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    salt: int = SALT,
) -> DataFrame:
    """Vectors on an integer grid, each with the nearest of ``clusters`` centroids after ``rounds`` rounds.

    A component x becomes floor(``scale`` * x). Vectors that are NULL, have another
    number of components, or a NULL or non-finite one take no part. Centroids
    start as the vectors whose ``<salt>:<id>`` has the smallest SHA-256; vectors
    without an id come last, and vectors of one id follow their components.
    A round assigns every vector and replaces every centroid that has any by
    the floor of their mean; the vectors are assigned once more at the end. Ties
    go to the smaller centroid number.

    Returns ``vec_id``, ``cluster``, the squared ``distance``, ``cluster_inertia``
    and ``inertia`` (distances summed over the cluster and over all), and
    ``centroid_sha256`` of the centroid's components as decimal numbers joined by
    commas. Repeated rows each count and each stay. Fewer vectors than ``clusters``
    make fewer centroids, an empty table an empty result. Other columns are not
    read. Components too large for distances of 64 bits raise an error.

    A round reads the stored integers once and shuffles a row per task, cluster
    and component; the driver holds the centroids alone.
    """
    spark = bounded_batches(vectors.sparkSession)
    kept = stored(grid(vectors, id_column, vector, dimensions, scale), "grid-vectors")
    rank = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    seeds = kept.select("x", rank.alias("rank")).orderBy(F.col("rank").asc_nulls_last(), "x").limit(clusters).collect()
    if not seeds:
        return spark.createDataFrame([], FOUND)
    centroids = np.array([row.x for row in seeds], np.int64)
    for _ in range(rounds):
        counts, totals = _sums(kept, centroids)
        for cluster in np.flatnonzero(counts):
            centroids[cluster] = [total // counts[cluster] for total in totals[cluster]]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids)
        for batch in batches:
            cluster, distance = search.nearest(_matrix(batch.column("x"), dimensions))
            columns = [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    assigned = stored(kept.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned-vectors")
    # A row per centroid.
    inertia = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    described = [
        (c, own, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c, own in inertia.items()
    ]
    names = spark.createDataFrame(described, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(names), "cluster").select("vec_id", "cluster", "distance", *names.columns[1:])
