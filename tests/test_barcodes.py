"""Barcode calls by local alignment against plain Smith-Waterman over all tags."""

import random

from sporeline.operators import align, barcodes
from tests.test_align import made, mutated


def plain(tag, read):
    """Best (score, tag bases, -stop) by a full table."""
    h = [[(0, 0)] * (len(read) + 1) for _ in range(len(tag) + 1)]
    best = (0, 0, 0)
    for i in range(1, len(tag) + 1):
        for j in range(1, len(read) + 1):
            step = 4 if tag[i - 1] == read[j - 1] else -13
            ways = [(h[i - 1][j - 1][0] + step, h[i - 1][j - 1][1] + 1), (h[i - 1][j][0] - 7, h[i - 1][j][1] + 1), (h[i][j - 1][0] - 7, h[i][j - 1][1])]
            top = max(ways)
            h[i][j] = top if top[0] > 0 else (0, 0)
            best = max(best, (*h[i][j], -j) if h[i][j][0] else best)
    return best


def test_local_alignment_is_the_best(spark):
    rng = random.Random(1)
    tags, reads = [], []
    for _ in range(120):
        tags.append(made(rng, rng.randint(1, 20)))
        reads.append(made(rng, rng.randint(0, 10)) + mutated(rng, tags[-1], 0.15) + made(rng, rng.randint(0, 20)))
    got = align.local([t.encode() for t in tags], [r.encode() for r in reads]).tolist()
    for t, r, (score, span, stop) in zip(tags, reads, got):
        want = plain(t, r)
        assert (score, span) == want[:2] and (stop == -want[2] or not score), (t, r)


def calls_of(reads, tags, window, least, span, lead):
    out = {}
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    for row, seq in reads:
        for side, w in ((5, seq[:window]), (3, turn(seq[-window:]))):
            found = []
            for name, t in tags.items():
                score, bases, stop = plain(t, w)
                if 100 * score / (4 * len(t)) >= least and bases / len(t) >= span:
                    found.append((-100 * score / (4 * len(t)), name, -stop))
            found.sort()
            if found and (len(found) == 1 or found[1][0] - found[0][0] >= lead):
                out[row, side] = (found[0][1], round(-found[0][0], 9))
    return out


def test_calls_equal_all_alignments(spark):
    rng = random.Random(2)
    tags = {f"t{i}": made(rng, n) for i, n in enumerate([12, 16, 16, 20, 24, 9])}
    tags["near"] = mutated(rng, tags["t1"], 0.1)
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = []
    for i in range(80):
        a, b = rng.choice(list(tags.values())), rng.choice(list(tags.values()))
        reads.append((i, made(rng, rng.randint(0, 5)) + mutated(rng, a, rng.choice([0, 0.05, 0.15])) + made(rng, 60) + turn(mutated(rng, b, rng.choice([0, 0.1]))) + made(rng, 3)))
    reads += [(98, ""), (99, "ACG")]
    df = spark.createDataFrame([*reads, (100, None)], "row long, seq string")
    tag_df = spark.createDataFrame(list(tags.items()), "tag string, seq string")
    for least, span, lead in ((70.0, 0.75, 0.0), (50.0, 0.5, 10.0), (85.0, 0.9, 0.0)):
        got = {(r.row, r.side): (r.tag, round(r.score, 9)) for r in barcodes.calls(df, tag_df, 40, least, span, lead).collect()}
        assert got == calls_of([(r, s) for r, s in reads if s], tags, 40, least, span, lead) and len(got) > 60


def test_samples_by_tags(spark):
    rng = random.Random(3)
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    a, b = made(rng, 16), made(rng, 20)
    inner = made(rng, 80)
    tags = spark.createDataFrame([("a", a), ("b", b)], "tag string, seq string")
    whole = a + inner + turn(b)
    broken = a[:8] + a[9:] + inner + turn(b[:10] + "A" + b[10:])
    reads = spark.createDataFrame([("x", whole), ("x", turn(whole)), ("y", broken), ("z", a + inner + turn(a)), ("n", inner)], "id string, seq string")
    samples = spark.createDataFrame([("s1", "a", "b"), ("s2", "a", "a")], "sample string, tag1 string, tag2 string")
    got = sorted((r.sample, r.id, r.seq) for r in barcodes.demultiplex_aligned(reads, tags, samples, window=40).collect())
    assert got == sorted([("s1", "x", inner), ("s1", "x", turn(inner)), ("s1", "y", inner), ("s2", "z", inner)])
    single = barcodes.demultiplex_aligned(reads, tags, samples.filter("sample = 's2'"), "single", window=40)
    assert {r.id for r in single.collect()} >= {"z"} and barcodes.demultiplex_aligned(reads.limit(0), tags, samples).count() == 0


def test_tags_of_several_lengths_by_mismatches(spark):
    """Against all windows and tags; reads that share an id stay apart."""
    from sporeline.operators import tags as T

    rng = random.Random(5)
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    known = {f"s{i}": made(rng, n) for i, n in enumerate([5, 6, 6, 8, 9])}
    reads = []
    for i in range(60):
        t = list(rng.choice(list(known.values())))
        if i % 3 == 0:
            t[rng.randrange(len(t))] = rng.choice("ACGT")
        read = made(rng, rng.randint(0, 4)) + "".join(t) + made(rng, 30)
        reads.append((i // 2, read if i % 4 else turn(read)))
    reads += [(100, ""), (101, None)]
    want = []
    for i, r in reads:
        best = None
        for s in (r, turn(r)) if r else ():
            w = s[:12]
            for name, t in known.items():
                for at in range(len(w) - len(t) + 1):
                    n = sum(x != y for x, y in zip(w[at:], t))
                    if n <= 1 and (best is None or (n, at, name) < best):
                        best = (n, at, name)
        if best:
            want.append((i, best[2], best[1], best[0]))
    df = spark.createDataFrame(reads, "id long, seq string").repartition(3)
    listed = spark.createDataFrame(list(known.items()), "sample string, tag string")
    got = sorted(tuple(r) for r in T.demultiplex(df, listed, window=12).collect())
    assert got == sorted(want) and len(got) > 40
    two = T.demultiplex_pairs(spark.createDataFrame([(1, "AA" + known["s3"] + "CCC", "GG"), (1, "T" * 20, known["s0"] + "ACC")], "id long, r1 string, r2 string"), listed, window=12, errors=0)
    assert sorted((r.sample, r.swapped, r.r1, r.r2) for r in two.collect()) == [("s0", True, "ACC", "T" * 20), ("s3", False, "CCC", "GG")]
