import numpy as np
from pyspark.sql import functions as F

from kerbside.llm import neighbours as nn

SCHEMA = "vec_id long, embedding array<float>, label int, score double, dim string"


def brute(vectors, queries, k):
    out = []
    for q in sorted(queries):
        near = sorted((float(np.sqrt(sum((np.float64(a) - np.float64(b)) ** 2 for a, b in zip(vectors[q], v, strict=True)))), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near[:k])]
    return out


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 1.0, "x") for i, v in vectors], SCHEMA)


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = {i: rng.normal(size=24).astype(np.float32).tolist() for i in range(300)}
    vectors |= {i: vectors[7] for i in range(300, 340)}  # one very common vector: ties
    vectors |= {i: (np.array(vectors[1]) * 1e-3).tolist() for i in range(340, 345)}
    found = nn.search(frame(spark, vectors.items()), F.col("vec_id") % 20 == 0, k=10, query_block=6, candidate_block=90)
    got = sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())
    want = brute({i: np.float32(v).tolist() for i, v in vectors.items()}, [i for i in vectors if i % 20 == 0], 10)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12, atol=0)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(20, 33)) * 10.0 ** rng.integers(-6, 6, (20, 1)), rng.normal(size=(50, 33))
    low, high = nn.Quantised(a).bounds(slice(0, 20), nn.Quantised(b), slice(0, 50))
    exact = ((a[:, None] - b[None]) ** 2).sum(axis=2)
    assert (low <= exact).all() and (exact <= high).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0])]
    rows += [(6, [None, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (40, [1.0] * 5)]
    got = sorted(tuple(r) for r in nn.search(frame(spark, rows), F.col("vec_id") % 20 == 0).collect())
    assert [g[:3] for g in got] == [(0, 1, 7), (0, 2, 20), (20, 1, 0), (20, 2, 7)]
    assert nn.search(frame(spark, rows).limit(0), F.col("vec_id") % 20 == 0).count() == 0
