"""Paired reads and overlaps against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from sporeline.operators import cluster, derep, tags


def poly_g(seq, least):
    """Bases to cut, by the rule in words."""
    miss = cut = 0
    for n, base in enumerate(reversed(seq), 1):
        miss += base != "G"
        if miss > 5 or (miss > n // 8 and n >= least):
            n -= 1
            break
        cut = n if base == "G" else cut
    return cut if seq and n >= least else 0


def test_poly_g_tails(spark):
    rng = random.Random(5)
    seqs = ["", "G", "ACGT", "G" * 30, "ACGT" + "G" * 10, "ACGT" + "G" * 9, "T" * 40]
    seqs += ["".join(rng.choice("ACGT" + "G" * rng.choice((1, 30))) for _ in range(rng.randint(5, 90))) for _ in range(300)]
    rows = spark.createDataFrame([(s,) for s in seqs], "seq string").select("seq", derep.trim_poly_g(F.col("seq"), 10).alias("cut"))
    for r in rows.collect():
        assert r.cut == poly_g(r.seq, 10), r.seq


def test_paired_qc_edges(spark):
    good, bad = "I" * 100, "!" * 100
    rows = [("ok", "A" * 100, good, "C" * 100, good), ("short", "A" * 99, good[:99], "C" * 100, good), ("low", "A" * 100, good, "C" * 100, bad), ("n", "N" * 6 + "A" * 94, good, "C" * 100, good), ("null", None, None, "C" * 100, good), ("empty", "", "", "", "")]
    pairs = spark.createDataFrame(rows, "id string, r1 string, q1 string, r2 string, q2 string")
    assert [r.id for r in derep.paired_qc(pairs).collect()] == ["ok"]
    assert derep.paired_qc(pairs.filter("id is null"), poly_g=10).count() == 0


def fits(u, v, coverage):
    return any(
        (j - i) >= coverage * len(u) - 1e-9 and u[i:j] == v[i - m : j - m]
        for m in range(-len(v), len(u) + 1)
        for i, j in [(max(0, m), min(len(u), m + len(v)))]
        if j > i
    )


@pytest.mark.parametrize("coverage", [0.96, 0.8])
def test_overlaps_and_clusters(spark, coverage):
    rng = random.Random(9)
    bases = ["".join(rng.choice("ACGT") for _ in range(rng.randint(20, 70))) for _ in range(6)] + ["A" * 40, "A" * 43, "AC" * 20]
    seqs = set(bases)
    for b in bases:
        for _ in range(6):
            i, j = rng.randint(0, 4), len(b) - rng.randint(0, 4)
            seqs.add("".join(rng.choice("ACGT") for _ in range(rng.randint(0, 3))) + b[i:j])
    rows = [(s, rng.randint(1, 5)) for s in sorted(seqs)]
    table = spark.createDataFrame(rows, "seq string, size long")
    links = {(r.u, r.v) for r in cluster.overlap_links(table.select("seq"), coverage).collect()}
    assert links == {(u, v) for u, _ in rows for v, _ in rows if u != v and fits(u, v, coverage)}
    want, centres = {}, []
    for s, n in sorted(rows, key=lambda r: (-r[1], r[0])):
        able = [c for c in centres if (s, c[0]) in links]
        if able:
            want[s] = min(able, key=lambda c: (-c[1], c[0]))[0]
        else:
            want[s] = s
            centres.append((s, n))
    assert {r.seq: r.centroid for r in cluster.contained(table, coverage).collect()} == want
    assert cluster.contained(table.filter("size > 99"), coverage).count() == 0


def test_two_rounds_and_both_ends(spark):
    codes = spark.createDataFrame([("s1", "ACGTAC"), ("s2", "TTGACA")], "sample string, tag string")
    pairs = spark.createDataFrame(
        [(1, "GACGTACTTTT", "CCCCCCCC"), (2, "CCCCCCCC", "TTGACAGGGG"), (3, "CCCCCCCC", "CCCCCCCC"), (4, "ACGTAATTTT", "TTGACAGG"), (5, None, "ACGTACA")], "id long, r1 string, r2 string"
    )
    got = {r.id: tuple(r)[1:] for r in tags.demultiplex_pairs(pairs, codes, 6).collect()}
    assert got == {1: ("s1", False, "TTTT", "CCCCCCCC"), 2: ("s2", True, "GGGG", "CCCCCCCC"), 4: ("s1", False, "TTTT", "TTGACAGG"), 5: ("s1", True, "A", None)}
    samples = spark.createDataFrame([("x", "ACGTAC", "TTGACA")], "sample string, tag1 string, tag2 string")
    # The second tag's reverse complement is TGTCAA.
    reads = spark.createDataFrame([(1, "ACGTACCCCCTGTCAA"), (2, "TTGACAGGGGGTACGT".replace("GTACGT", "GTACGT")), (3, "ACGTACCCCCCCCCCC")], "id long, seq string")
    got = {r.id: (r.sample, r.strand, r.errors) for r in tags.demultiplex_dual(reads, samples, 6, 8, 0).collect()}
    assert got == {1: ("x", "+", 0), 2: ("x", "-", 0)}


def test_long_lists_are_joined(spark, monkeypatch):
    """Lists over the bound were an error; now they are joined without a broadcast, with the same result."""
    codes = spark.createDataFrame([("s1", "AC"), ("s2", "TT")], "sample string, tag string")
    reads = spark.createDataFrame([(1, "ACGT"), (2, "GGTT"), (3, "GGGG")], "id long, seq string")
    want = sorted(map(tuple, tags.demultiplex(reads, codes, 2, 4, 0).collect()))
    monkeypatch.setattr(tags, "MOST_LISTED", 1)
    assert sorted(map(tuple, tags.demultiplex(reads, codes, 2, 4, 0).collect())) == want and len(want) == 2
