import hashlib
import math
import random

import numpy as np
import pytest

from sporeline.llm import centroids
from tests.oracle import rows_match

SF = "/root/testdata/sf0.001"


def brute(rows, k=40, rounds=5, dim=64):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"2:{'null' if i is None else i}".encode()).hexdigest()
    cs = [v for _, v in sorted(((name(i), v) for i, v in kept))[:k]]
    if not cs:
        return []
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        groups = [[v for (_, v), j in zip(kept, of) if j == c] for c in range(len(cs))]
        cs = [[sum(col) // len(g) for col in zip(*g)] if g else c for g, c in zip(groups, cs)]
    last = [near(v) for _, v in kept]
    each = [sum(d for d, j in last if j == c) for c in range(len(cs))]
    fits = lambda v: v if v < 2**63 else None
    mark = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, j, fits(d), fits(each[j]), fits(sum(each)), mark[j]) for (i, _), (d, j) in zip(kept, last)), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def test_query_against_sql(spark):
    assert rows_match(spark, centroids.op12_centroid_clusters, centroids.ORACLES["op12_centroid_clusters"], SF) > 400


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e15, 1e30])
def test_magnitudes_against_brute_force(spark, scale):
    """Small rows with a few large ones: products, int64 and Python integers."""
    rng = random.Random(4)
    rows = [(i, [rng.choice([rng.random() - 0.5, 0.25, -0.25]) * (scale if i % 9 == 0 else 1) for _ in range(4)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert rows_of(centroids.cluster(df, k=7, rounds=3, dim=4)) == brute(rows, 7, 3, 4)


def test_odd_rows(spark):
    rows = [
        (1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [5.0, 5.0]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]),
        (7, []), (8, [-0.001, -3.5]), (9, [5.0, 5.0]), (10, [2.5, 3.0]), (11, [1.25, 2.0]),
    ]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, cluster int, distance string")
    for k in (1, 3, 40):
        assert rows_of(centroids.cluster(df, k=k, rounds=4, dim=2)) == brute(rows, k, 4, 2)
    assert rows_of(centroids.cluster(df.limit(0), dim=2)) == [] == rows_of(centroids.cluster(df, dim=3))


def test_products_equal_integers():
    rng = np.random.default_rng(1)
    whole = lambda a: np.array([[int(v) for v in row] for row in a], object)
    x, c = (np.floor(rng.normal(size=(n, 64)) * 1e4) for n in (50, 7))
    want = ((x.astype(np.int64)[:, None] - c.astype(np.int64)) ** 2).sum(2)
    assert (centroids.squared(x, whole(c)) == want).all() and centroids.squared(x, whole(c)).dtype == np.int64
    assert (centroids.squared(x * 1e4, whole(c * 1e4)) == want.astype(object) * 10**8).all()
