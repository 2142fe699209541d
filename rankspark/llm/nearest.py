"""Approximate nearest neighbours by a block matrix join of int8 tiles.

Queries and candidates are dealt into blocks of bounded size; every pair of a query
block and a candidate block is one cell of a grid, worked on by one task.  In a cell
each vector is rounded to int8 with a scale of its own.  The product of the two
int8 tiles gives, for each query and candidate, the distance of the rounded vectors;
by the triangle inequality the true distance differs from it by at most the two
rounding errors, whose lengths are known.  Candidates whose least possible distance
exceeds the k-th least largest possible distance cannot be among the k nearest;
the others are computed again in double precision and go through a heap of k per
query.  The cells' heaps are merged by a window per query.  Nothing found is lost:
the bounds are exact, so recall is 1.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESULT = "query_id long, rank int, vec_id long, score double"
# int8 products are summed in float32, exact up to 2**24: so many dimensions at a time
CHUNK = 1024


def usable(vector: Column) -> Column:
    """True for vectors that are not null, empty or zero and hold finite numbers only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(
        (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scales, lengths of the rounded vectors, lengths of the rounding errors)."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = 1.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    rounded = codes * scale[:, None]
    return codes, scale, np.sqrt((rounded**2).sum(1)), np.sqrt(((x - rounded) ** 2).sum(1))


def tile_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], CHUNK):
        part = a[:, at : at + CHUNK].astype(np.float32) @ b[:, at : at + CHUNK].astype(np.float32).T
        total += part
    return total


def block_unit(*blocks: np.ndarray) -> float:
    """1, or for components beyond 2**500 a power of two near the largest."""
    largest = max(float(np.abs(b).max(initial=0.0)) for b in blocks)
    return 1.0 if largest < 2.0**500 else 2.0 ** np.floor(np.log2(largest))


def distances(x: np.ndarray, q: np.ndarray, unit: float) -> np.ndarray:
    """Euclidean distances in double precision; the unit only keeps squares in range."""
    with np.errstate(over="ignore", invalid="ignore"):
        plain = np.sqrt(((x - q) ** 2).sum(axis=1))
    if unit == 1.0:
        return plain
    scaled = np.sqrt((((x / unit) - (q / unit)) ** 2).sum(axis=1)) * unit
    return np.where(np.isfinite(plain), plain, scaled)


def nearest_in_tile(q_ids, q, ids, x, k: int) -> Iterator[tuple[int, float, int]]:
    """The k nearest rows of ``x`` for each row of ``q`` as (query, distance, id)."""
    # bounds are taken of components scaled by a power of two, so that no square overflows
    unit = block_unit(q, x)
    qc, qs, qn, qe = quantise(q / unit)
    xc, xs, xn, xe = quantise(x / unit)
    dots = tile_product(qc, xc) * qs[:, None] * xs[None, :]
    middle = np.sqrt(np.maximum(qn[:, None] ** 2 + xn[None, :] ** 2 - 2 * dots, 0))
    error = qe[:, None] + xe[None, :] + 1e-7 * (qn[:, None] + xn[None, :])
    # what squares lose below the least double
    error += 1e-300 if unit == 1.0 else 1e-150
    for i, query in enumerate(q_ids):
        upper = middle[i] + error[i]
        own = ids == query
        upper[own] = np.inf
        others = len(ids) - int(own.sum())
        if others <= 0:
            continue
        bound = np.partition(upper, k - 1)[k - 1] if others >= k else np.inf
        keep = np.flatnonzero((middle[i] - error[i] <= bound) & ~own)
        exact = distances(x[keep], q[i], unit)
        for d, key in heapq.nsmallest(k, zip(exact.tolist(), ids[keep].tolist(), strict=True)):
            yield int(query), d, key


def _cell(k: int, tile: int):
    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        heaps: dict[int, list[tuple[float, int]]] = {}
        if len(left) and len(right):
            right = right.sort_values("vec_id", kind="stable")
            sizes_l, sizes_r = left["vector"].map(len), right["vector"].map(len)
            for size in sorted(set(sizes_l) & set(sizes_r)):
                some_l, some_r = left[sizes_l == size], right[sizes_r == size]
                q = np.stack(some_l["vector"].to_numpy()).astype(np.float64)
                q_ids = some_l["vec_id"].to_numpy()
                for at in range(0, len(some_r), tile):
                    part = some_r.iloc[at : at + tile]
                    x = np.stack(part["vector"].to_numpy()).astype(np.float64)
                    for query, d, key in nearest_in_tile(q_ids, q, part["vec_id"].to_numpy(), x, k):
                        heap = heaps.setdefault(query, [])
                        # the heap's head is its worst entry
                        entry = (-d, -key)
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
        out = [(query, -d, -key) for query, heap in heaps.items() for d, key in heap]
        return pd.DataFrame(out, columns=["query_id", "score", "vec_id"]).astype(
            {"query_id": "int64", "score": "float64", "vec_id": "int64"}
        )

    return work


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_rows: int = 1024,
    candidate_rows: int = 16384,
    tile: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of ``vectors`` for each query.

    Distance is Euclidean in double precision, ties go to the smaller id.  A query
    never meets rows of its own id.  Rows whose id is null or whose vector is not
    :func:`usable` take no part on either side; vectors of another length than the
    query's are no candidates.  Components may have any finite size.  Ids that occur more than once are rows of their own
    (equal queries are asked once).  Empty tables give an empty result; other columns
    are ignored.  Blocks are sized by row counts, so their number grows with the
    data and a task's memory does not.
    """
    side = lambda df: df.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    asked, rows = side(queries).distinct(), side(vectors)
    n_q = max(1, -(-asked.count() // query_rows))
    n_c = max(1, -(-rows.count() // candidate_rows))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("qb", deal(n_q)).withColumn("cb", every(n_c))
    # equal vectors must not share a block: all rows of a hot vector would meet
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(n_c)).cast("int")
    right = rows.withColumn("cb", spread).withColumn("qb", every(n_q))
    found = (
        left.groupBy("qb", "cb")
        .cogroup(right.groupBy("qb", "cb"))
        .applyInPandas(_cell(k, tile), "query_id long, score double, vec_id long")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
