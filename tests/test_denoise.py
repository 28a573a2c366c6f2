"""Denoising recovers what a seeded simulation put in."""

import math
import random
from collections import Counter

import numpy as np

from sporeline.operators import align, denoise
from tests.test_align import made, mutated


def test_counts_of_the_best_alignment():
    rng = random.Random(1)
    for _ in range(40):
        u = made(rng, rng.randint(1, 25))
        v = made(rng, rng.randint(0, 3)) + mutated(rng, u, 0.2) + made(rng, rng.randint(0, 3))
        n, m = len(u), len(v)
        # Best score by a full table, gaps free at the ends, and the score that the counts stand for.
        h = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(1, n + 1):
            for j in range(1, m + 1):
                h[i][j] = max(h[i - 1][j - 1] + (5 if u[i - 1] == v[j - 1] else -4), h[i - 1][j] - 8, h[i][j - 1] - 8)
        best = max(max(h[n]), max(row[m] for row in h))
        counts = align.transitions([u.encode()], [v.encode()], np.array([-n]), np.array([m]))[0].reshape(4, 4)
        good, bad = int(np.trace(counts)), int(counts.sum() - np.trace(counts))
        assert (5 * good - 4 * bad - best) % 8 == 0 and 5 * good - 4 * bad >= best
        if n == m and sum(x != y for x, y in zip(u, v)) <= 1:
            assert good == sum(x == y for x, y in zip(u, v))


def test_poisson_tail():
    for reads, mean in ((1, 0.01), (3, 0.5), (10, 4.0), (5, 9.0)):
        want = 1 - sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(reads))
        assert abs(denoise.tail(reads, mean, False) - want) < 1e-12
        assert abs(denoise.tail(reads, mean) - want / (1 - math.exp(-mean))) < 1e-9
    assert denoise.tail(3, 0.0) == 0.0 and denoise.tail(500, 1e-6) == 0.0


def simulated(rng, truth, rate):
    reads = Counter()
    for seq, n in truth.items():
        for _ in range(n):
            reads["".join(rng.choice([x for x in "ACGT" if x != c]) if rng.random() < rate else c for c in seq)] += 1
    return reads


def test_simulation_is_recovered(spark):
    rng = random.Random(11)
    change = lambda s, *at: "".join(("ACGT"["ACGT".index(c) - 1] if i in at else c) for i, c in enumerate(s))
    a, b = made(rng, 90), made(rng, 90)
    one = {a: 600, change(a, 10, 50, 70): 150, change(a, 11, 12, 13, 80): 60, b: 300}
    two = {b: 250, change(b, 20, 44): 120}
    rows = []
    for bucket, truth in (("x", one), ("y", two)):
        rows += [(bucket, f"{bucket}{i}", s, n) for i, (s, n) in enumerate(sorted(simulated(rng, truth, 0.004).items()))]
    derep = spark.createDataFrame(rows, "bucket string, id string, seq string, size long")
    err, _ = denoise.learn(derep.select("bucket", "seq", "size"))
    assert 0.003 < (1 - np.diag(err)).mean() < 0.005 and np.allclose(err.sum(1), 1)
    out = denoise.denoise(derep).collect()
    seq_of = {(r.bucket, r.id): r.seq for r in out}
    assert len(out) == len(rows)
    found = {(r.bucket, seq_of[r.bucket, r.target]) for r in out if r.target}
    assert found == {("x", s) for s in one} | {("y", s) for s in two}
    reads = Counter()
    for r in out:
        if r.target:
            reads[r.bucket, seq_of[r.bucket, r.target]] += r.size
    assert all(abs(reads["x", s] - n) <= 3 for s, n in one.items()) and all(abs(reads["y", s] - n) <= 3 for s, n in two.items())


def test_rounds_and_discarded(spark):
    rows = [("x", "A" * 40, 100), ("x", "A" * 39 + "C", 1), ("x", "G" * 40, 1), ("x", "A" * 20 + "C" + "A" * 19, 60), ("y", "A" * 39 + "C", 1), ("z", "", 3)]
    derep = spark.createDataFrame(rows, "bucket string, seq string, size long")
    err = np.full((4, 4), 0.001) + np.eye(4) * 0.996
    got = {(r.bucket, r.seq): r.centre for r in denoise.infer(derep, err).collect()}
    assert got == {("x", rows[0][1]): rows[0][1], ("x", rows[1][1]): rows[0][1], ("x", rows[2][1]): None, ("x", rows[3][1]): rows[3][1], ("y", rows[4][1]): None, ("z", ""): ""}
    assert denoise.infer(derep.limit(0), err).collect() == []
