import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rankspark.llm import centroids

VECTORS = "vec_id long, embedding array<double>, cluster int, distance long, x string"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 7), st.integers(1, 9), st.integers(1, 5), st.randoms(use_true_random=False))
def test_walk_finds_the_nearest_of_all(n, k, d, rng):
    # few values, so that ties and equal centroids are frequent
    x = np.array([[rng.randint(-4, 4) for _ in range(d)] for _ in range(n)], np.int64)
    c = np.array([[rng.randint(-4, 4) for _ in range(d)] for _ in range(k)], np.int64)
    number, distance = centroids.Nearest(c)(x)
    every = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    assert number.tolist() == every.argmin(axis=1).tolist()
    assert distance.tolist() == every.min(axis=1).tolist()


def test_walk_stops_before_all_centroids_are_met():
    far = np.array([[1000 * i] * 3 for i in range(50)], np.int64)
    walk = centroids.Nearest(far)
    number, distance = walk(np.array([[1, 0, 2], [48999, 49001, 49000]], np.int64))
    assert number.tolist() == [0, 49] and distance.tolist() == [5, 2] and walk.steps == 2


def plain(rows, k, rounds, d):
    """The contract, row by row."""
    kept = [
        (key, [math.floor(1024 * x) for x in v])
        for key, v in rows
        if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    middles = [v for _, v in sorted(kept, key=digest)[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    place = lambda v: min((square(v, c), i) for i, c in enumerate(middles))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(place(v)[1], []).append(v)
        middles = [
            [sum(col) // len(groups[i]) for col in zip(*groups[i], strict=True)] if i in groups else c
            for i, c in enumerate(middles)
        ]
    told = [(key, *reversed(place(v))) for key, v in kept]
    total = sum(r[2] for r in told)
    return [
        (key, c, dist, sum(r[2] for r in told if r[1] == c), total,
         hashlib.sha256(",".join(map(str, middles[c])).encode()).hexdigest())
        for key, c, dist in told
    ]


@pytest.mark.parametrize("n", [0, 3, 60])
def test_against_the_contract(spark, n):
    rng = random.Random(n)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(n)]
    if n > 3:
        rows += [(i, rows[0][1]) for i in range(n, n + 30)]  # a hot vector
        rows += [(5, [0.0, 0.0, 0.0]), (5, [0.5, 0.5, 0.5]), (None, [0.25, 0.25, 0.25])]
        rows += [(90, None), (91, [1.0]), (92, [1.0, None, 2.0]), (93, [1.0, float("nan"), 2.0])]
        rows += [(94, [1.0, float("-inf"), 2.0]), (95, [])]
    table = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], VECTORS).repartition(3)
    got = centroids.cluster(table, k=4, rounds=5, dimensions=3)
    want = plain(rows, 4, 5, 3)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert got.columns == [c.split()[0] for c in centroids.RESULT.split(", ")]


def test_components_out_of_range_raise(spark):
    table = spark.createDataFrame([(1, [1e200, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="leaves the range"):
        centroids.cluster(table, dimensions=2).collect()
