import math

import numpy as np
from rankspark.llm import nearest as nn


def brute(rows, queries, k):
    out = []
    for q, v in queries:
        near = sorted((float(np.sqrt(((np.float64(w) - np.float64(v)) ** 2).sum())), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near[:k])]
    return sorted(out)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * 10.0 ** rng.integers(-3, 4)).tolist()) for i in range(150)]
    rows += [(i, rows[0][1]) for i in range(200, 260)] + [(300, [1.0, 2.0]), (310, [1.0, 2.5])]
    bad = [(400, None), (410, [0.0] * 8), (420, [float("nan")] * 8), (430, [1.0, None] * 4), (440, [float("inf")] * 8), (450, []), (None, [1.0] * 8)]
    table = spark.createDataFrame([(i, v, 0.0, 1) for i, v in rows + bad], "vec_id long, embedding array<double>, score double, rank int")
    asked = table.filter("vec_id % 10 = 0")
    queries = [(i, v) for i, v in rows if i % 10 == 0]
    for sizes in ({}, {"query_rows": 7, "candidate_rows": 40, "tile": 16}):
        got = sorted(map(tuple, nn.nearest(table, asked, k=5, **sizes).collect()))
        want = brute(rows, queries, 5)
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12, atol=0)
    assert nn.nearest(table.limit(0), asked, k=5).count() == 0
    assert nn.nearest(table, asked.limit(0), k=5).count() == 0


def test_components_of_any_size(spark):
    """Squares that overflow or vanish beside others lose no candidate."""
    rows = [(0, [1e200, 0.0, 0.0]), (1, [1e200, 1e199, 0.0]), (2, [-1e200, 0.0, 1e200]), (3, [1.0, 2.0, 3.0])]
    rows += [(4, [1.0, 2.0, 3.5]), (5, [1e40, 2.0, 3.0]), (6, [1.0, -2.0, 3.0]), (7, [1e-5, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nn.nearest(table, table, k=5).orderBy("query_id", "rank").collect()
    for q, v in rows:
        want = sorted((math.dist(v, w), i) for i, w in rows if i != q)[:5]
        own = [r for r in got if r.query_id == q]
        assert np.allclose([r.score for r in own], [d for d, _ in want], rtol=1e-12, atol=0)
        assert [r.vec_id for r in own] == [i for _, i in want]


def test_int8_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 1500))
    codes, scale, length, error = nn.quantise(x)
    assert (nn.tile_product(codes, codes) == codes.astype(np.int64) @ codes.astype(np.int64).T).all()
    for i in range(0, 40, 7):
        true = np.sqrt(((x - x[i]) ** 2).sum(1))
        rounded = np.sqrt(((codes * scale[:, None] - codes[i] * scale[i]) ** 2).sum(1))
        assert (np.abs(true - rounded) <= error + error[i] + 1e-9).all()
