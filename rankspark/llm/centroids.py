"""Centroid clustering of integer vectors by the threshold algorithm.

Lloyd's rounds in exact integer arithmetic.  To find the centroid nearest to a vector,
every dimension keeps the centroids sorted by their value there.  The lists are walked
outward from the vector's own value, the nearer side first.  A centroid met for the first
time, in whatever dimension, has its exact distance computed.  What no list has shown yet
lies, in each dimension, at least as far away as that list's frontier; once the sum of the
squared frontier distances strictly exceeds the best exact distance, no unseen centroid
can be nearer or tie, and the walk ends.  All vectors of a batch take their steps together.

The centroids (``k`` times ``dimensions`` numbers) go through the driver between rounds;
vectors never do: a round is one pass over a written table, in which every task adds up
its vectors per centroid before anything is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankspark.session import keep

RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
)
BATCH = 4096


def whole(vector: Column, dimensions: int) -> Column:
    """True for vectors of so many components of which none is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & ~bad, F.lit(False))


def grid_vectors(
    vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int
) -> DataFrame:
    """(vec_id, x): the vectors that take part, as whole numbers floor(scale * component).

    Numbers whose squared distances could leave the range of BIGINT raise.
    """
    most = int((2**61 / dimensions) ** 0.5)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    ).filter(whole(F.col("vector"), dimensions))
    problem = F.raise_error(F.lit(f"a component times {scale} leaves the range of +-{most}"))

    def cell(x: Column) -> Column:
        scaled = F.floor(x * F.lit(float(scale)))
        return F.when(F.abs(x) <= most / scale, scaled.cast("long")).otherwise(problem.cast("long"))

    return rows.select("vec_id", F.transform("vector", cell).alias("x"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of least SHA-256 of ``seed:vec_id``, in the order of the hash.

    Of rows with one id the vector that sorts first comes first; rows without an id come last.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    least = rows.orderBy(key.asc_nulls_last(), "x").limit(k).collect()
    return np.array([r.x for r in least], np.int64)


class Nearest:
    """Finds nearest centroids through one sorted list of centroids per dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.k, self.dimensions = centroids.shape
        # stable: centroids of one value stand in ascending number
        self.order = np.argsort(centroids, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(centroids.T, self.order, axis=1)
        self.steps = 0

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of each row; ties: the smaller number."""
        n, k = len(x), self.k
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, k, np.int64)
        seen = np.zeros((n, k), bool)
        # right points at the first unshown value at or above the vector's, left at the one below
        right = np.empty((n, self.dimensions), np.int64)
        for d in range(self.dimensions):
            right[:, d] = np.searchsorted(self.values[d], x[:, d])
        left = right - 1
        active = np.arange(n)
        lists = np.arange(self.dimensions)
        while len(active):
            self.steps += len(active)
            own, lo, hi = x[active], left[active], right[active]
            below = self._gap(own - self.values[lists, np.maximum(lo, 0)], lo < 0)
            above = self._gap(self.values[lists, np.minimum(hi, k - 1)] - own, hi >= k)
            down = below <= above
            shown = self.order[lists, np.where(down, lo, hi)]
            fresh = np.zeros((len(active), k), bool)
            fresh[np.arange(len(active))[:, None], shown] = True
            fresh &= ~seen[active]
            seen[active] |= fresh
            self._measure(x, active, fresh, best, number)
            left[active], right[active] = lo - down, hi + ~down
            lo, hi = left[active], right[active]
            below = self._gap(own - self.values[lists, np.maximum(lo, 0)], lo < 0)
            above = self._gap(self.values[lists, np.minimum(hi, k - 1)] - own, hi >= k)
            frontier = np.minimum(below, above)
            # a list that is walked to its end has shown every centroid
            ended = (frontier == self.FAR).any(axis=1)
            threshold = (np.where(frontier == self.FAR, 0, frontier) ** 2).sum(axis=1)
            active = active[~(ended | (threshold > best[active]))]
        return number, best

    FAR = np.iinfo(np.int64).max

    def _gap(self, gap: np.ndarray, none: np.ndarray) -> np.ndarray:
        return np.where(none, self.FAR, gap)

    def _measure(self, x, active, fresh, best, number) -> None:
        """Exact distances of the centroids just met, one centroid at a time in ascending number."""
        for c in np.flatnonzero(fresh.any(axis=0)):
            rows = active[fresh[:, c]]
            exact = ((x[rows] - self.centroids[c]) ** 2).sum(axis=1)
            nearer = (exact < best[rows]) | ((exact == best[rows]) & (c < number[rows]))
            best[rows[nearer]], number[rows[nearer]] = exact[nearer], c


def _matrices(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            yield part.column(0), part.column(1).flatten().to_numpy().reshape(-1, dimensions)


def _sums_task(centroids: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids)
        k, dimensions = centroids.shape
        counts, totals = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for _, x in _matrices(batches, dimensions):
            number, _ = nearest(x)
            order = np.argsort(number, kind="stable")
            here, first = np.unique(number[order], return_index=True)
            counts += np.bincount(number, minlength=k)
            totals[here] += np.add.reduceat(x[order], first, axis=0)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(list(totals[used]), pa.list_(pa.int64()))],
            ["cluster", "n", "total"],
        )

    return work


def next_centroids(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of each centroid's vectors; an empty centroid stays."""
    part = rows.mapInArrow(_sums_task(centroids), "cluster int, n long, total array<long>")
    summed = part.select("cluster", "n", F.posexplode("total").alias("d", "total")).groupBy("cluster", "d").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    out = centroids.copy()
    for r in summed.collect():
        out[r.cluster, r.d] = int(r.total) // r.n
    return out


def _label_task(centroids: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids)
        for ids, x in _matrices(batches, centroids.shape[1]):
            number, distance = nearest(x)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(number, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"]
            )

    return work


def fingerprint(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dimensions: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector that takes part (``RESULT``): its cluster and squared distance after ``rounds``.

    Vectors that are null, of another length, or hold a null or non-finite component
    take no part; zero vectors do.  Rows with equal ids or equal vectors are vectors of
    their own; a null id stays null and never starts a centroid before others.  Fewer
    vectors than ``k`` give fewer centroids, an empty table no rows.  Other columns are
    ignored.  A component so large that a squared distance could leave BIGINT raises.
    """
    spark = vectors.sparkSession
    rows = keep(grid_vectors(vectors, id_col, vector_col, dimensions, scale), "grid-vectors")
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    for _ in range(rounds):
        centroids = next_centroids(rows, centroids)
    told = keep(rows.mapInArrow(_label_task(centroids), "vec_id long, cluster int, distance long"), "clusters")
    # at most k rows
    parts = told.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    total = sum(int(r.inertia) for r in parts)
    final = spark.createDataFrame(
        [(r.cluster, int(r.inertia), total, fingerprint(centroids[r.cluster])) for r in parts],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return told.join(F.broadcast(final), "cluster").select(*[c.split()[0] for c in RESULT.split(", ")])
