"""The alignment kernel against a plain table, and candidates and match lists against all pairs."""

import random

import numpy as np

from sporeline.operators import align


def plain(u, v, s=align.Scoring(), low=None, high=None):
    """Best (score, matches, aligned, -gaps) by a full table with three states."""
    n, m = len(u), len(v)
    low, high = (-n if low is None else min(low, 0, m - n)), (m if high is None else max(high, 0, m - n))
    add = lambda a, *b: tuple(x + y for x, y in zip(a, b)) if a else None
    top = lambda *xs: max((x for x in xs if x), default=None)
    end = lambda k: -(s.end_open + s.end_extend * k) if k else 0
    h, f, e = {}, {}, {}
    for i in range(n + 1):
        for j in range(m + 1):
            if not low <= j - i <= high:
                continue
            if i == 0 or j == 0:
                h[i, j] = (end(i + j), 0, 0, 0)
                f[i, j] = e[i, j] = None
                continue
            same = u[i - 1] == v[j - 1]
            f[i, j] = top(add(h.get((i - 1, j)), -s.open - s.extend, 0, 0, -1), add(f.get((i - 1, j)), -s.extend, 0, 0, -1))
            e[i, j] = top(add(h.get((i, j - 1)), -s.open - s.extend, 0, 0, -1), add(e.get((i, j - 1)), -s.extend, 0, 0, -1))
            h[i, j] = top(add(h.get((i - 1, j - 1)), s.match if same else s.mismatch, int(same), 1, 0), f[i, j], e[i, j])
    ways = [h.get((n, m))] + [add(h.get((n, j)), end(m - j), 0, 0, 0) for j in range(m)] + [add(h.get((i, m)), end(n - i), 0, 0, 0) for i in range(n)]
    return top(*ways)


def mutated(rng, s, rate):
    out = []
    for c in s:
        r = rng.random()
        out.append("" if r < rate / 3 else rng.choice("ACGT") if r < rate * 2 / 3 else c + rng.choice("ACGT") * rng.randint(1, 3) if r < rate else c)
    return "".join(out)


def made(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_kernel_equals_a_plain_table():
    rng = random.Random(1)
    us, vs = [], []
    for _ in range(150):
        u = made(rng, rng.randint(0, 30)) if rng.random() < 0.5 else rng.choice(["ACAC", "AAAAAA"]) * rng.randint(0, 5)
        us.append(u)
        vs.append(made(rng, rng.randint(0, 6)) + mutated(rng, u, 0.3) + made(rng, rng.randint(0, 6)) if rng.random() < 0.8 else made(rng, rng.randint(0, 30)))
    code = lambda xs: [x.encode() for x in xs]
    wide = np.full(len(us), 1000)
    got = list(zip(*(x.tolist() for x in align.align(code(us), code(vs), -wide, wide))))
    for u, v, (score, matches, pairs, gaps) in zip(us, vs, got):
        assert (score, matches, pairs, -gaps) == plain(u, v), (u, v)
    low, high = np.array([rng.randint(-9, 3) for _ in us]), np.array([rng.randint(0, 9) for _ in us])
    got = list(zip(*(x.tolist() for x in align.align(code(us), code(vs), low, high))))
    for u, v, a, b, (score, matches, pairs, gaps) in zip(us, vs, low.tolist(), high.tolist(), got):
        assert (score, matches, pairs, -gaps) == plain(u, v, low=a, high=b), (u, v, a, b)


def test_very_long_reads_use_whole_integers():
    rng = random.Random(2)
    u = made(rng, 60_000)
    v = u[:30_000] + u[30_002:]
    score, matches, pairs, gaps = (int(x[0]) for x in align.align([u.encode()], [v.encode()], np.array([-4]), np.array([2])))
    assert (matches, pairs, gaps) == (59_998, 59_998, 2) and score == 2 * 59_998 - 24


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def families(rng, length, count, flank=0, repeats=False):
    """Families of mutated copies, with a flank that all share or a base of short repeats; lengths vary."""
    shared, out = made(rng, flank), set()
    for _ in range(count):
        own = length - flank
        base = (made(rng, 3) * own)[:own] if repeats else made(rng, own)
        for rate in (0.0, 0.01, 0.02, 0.03, 0.05):
            out.add((mutated(rng, base, rate) if rate else base) + mutated(rng, shared, rate / 3))
    return sorted(out)


def test_rarest_bits_cost_least():
    import itertools

    from sporeline.operators import candidates

    rng = np.random.default_rng(3)
    for _ in range(30):
        costs = {k: rng.integers(0, 9, (2, 14 - k + 1)).astype(float) for k in (2, 4)}
        need = int(rng.integers(1, 5))
        for row, chosen in enumerate(candidates.rarest(costs, 1, 13, need)):
            assert len(chosen) == need and all(1 <= a and a + k <= 13 for a, k in chosen)
            chosen = sorted(chosen)
            assert all(a + k <= b for (a, k), (b, _) in zip(chosen, chosen[1:]))
            every = [(a, k) for k in (2, 4) for a in range(1, 13 - k + 1)]
            fits = lambda c: all(x[0] + x[1] <= y[0] for x, y in zip(c, c[1:]))
            best = min(sum(costs[k][row][a] for a, k in c) for c in itertools.combinations(sorted(every), need) if fits(c))
            assert best == sum(costs[k][row][a] for a, k in chosen)


def test_similar_finds_all_pairs_at_every_length(spark):
    from sporeline.operators import graph

    rng = random.Random(5)
    seqs = families(rng, 80, 4) + families(rng, 300, 2, flank=150) + families(rng, 300, 1, repeats=True) + families(rng, 1500, 1, flank=150)
    seqs += families(rng, 200, 1) + ["A", "C", "AC", "ACG", "ACGTACGTAC", "ACGTACGTAA", ""]
    df = spark.createDataFrame([(s,) for s in seqs] + [(None,), (seqs[0],)], "seq string")
    n = {}
    for i, a in enumerate(sorted(set(seqs))):
        for b in sorted(set(seqs))[i + 1 :]:
            if a and b and min(len(a), len(b)) >= 0.89 * max(len(a), len(b)):
                n[a, b] = edits(a, b)
    for least in (0.9, 0.95, 0.97):
        want = {k: 1 - x / max(map(len, k)) for k, x in n.items() if 1 - x / max(map(len, k)) >= least - 1e-12}
        got = {(r.u, r.v): r.identity for r in graph.similar(df, least).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want) and len(want) > 20


def test_similar_at_one_length_does_not_depend_on_others(spark):
    from sporeline.operators import graph

    rng = random.Random(6)
    a, b = made(rng, 160), made(rng, 200)
    other = lambda s: s[:70] + ("A" if s[70] != "A" else "C") + s[71:]
    seqs = [a, other(a), b, other(b), made(rng, 300)]
    got = {(r.u, r.v) for r in graph.similar(spark.createDataFrame([(s,) for s in seqs], "seq string"), 0.95).collect()}
    assert got == {tuple(sorted((s, other(s)))) for s in (a, b)}


def test_matches_equal_all_alignments(spark):
    from sporeline.operators import graph

    rng = random.Random(7)
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    seqs = families(rng, 50, 2)[:8] + families(rng, 70, 1, flank=35)
    seqs += [turn(s) for s in seqs[::3]] + [made(rng, 7) + s[4:] for s in seqs[:3]] + [s[2:-2] for s in seqs[3:6]] + [s + made(rng, 20) for s in seqs[2:4]]
    seqs = sorted(set(seqs))
    df = spark.createDataFrame([(s,) for s in seqs], "seq string")
    for definition, coverage, both in ((1, 1.0, False), (2, 0.9, False), (2, 0.85, True)):
        want = {}
        for u in seqs:
            for v in seqs:
                if u == v or len(u) > len(v) or (len(u) == len(v) and v < u and not both):
                    continue
                for strand in "+-" if both else "+":
                    x = u if strand == "+" else turn(u)
                    if max(len(u), len(v)) > 2 * min(len(u), len(v)):
                        continue
                    _, good, pairs, gaps = plain(x, v)
                    ident = good / (len(u) + len(v) - pairs) if definition == 1 else good / (pairs - gaps)
                    if ident >= 0.95 - 1e-12 and (definition == 1 or pairs / len(u) >= coverage - 1e-12):
                        key = frozenset((u, v))
                        want[key] = max(want.get(key, 0), ident)
        got = {frozenset((r.u, r.v)): r.identity for r in graph.matches(df, 0.95, definition, coverage, both).collect()}
        missed = {k for k in want if k not in got or abs(got[k] - want[k]) > 1e-12}
        assert not missed, (definition, both, len(missed))
        assert got.keys() == want.keys()


def test_bits_between_fill_the_room_that_a_flank_leaves():
    """As in a corpus of 360,000 sequences with a flank in common: bits of 8 bases meet 2,000 others by chance, those of 12 nine."""
    import types

    import pyarrow as pa

    from sporeline.operators import candidates

    rng = random.Random(9)
    flank, menu, places = made(rng, 150), [8, 10, 12, 14, 16], 144_000_000
    counts = np.stack([np.full(candidates.COUNTERS, places // min(4**k, candidates.COUNTERS)) for k in menu])
    for row, k in enumerate(menu):
        counts[row][candidates._counter(candidates._codes(flank.encode(), k))] += 180_000
    seqs = [made(rng, own) + flank for own in (300, 450) for _ in range(10)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(seqs))), "seq": seqs})
    filed = next(candidates._file(menu, types.SimpleNamespace(value=counts), 0.95, 1.0, None)(iter([batch]))).to_pylist()
    assert 8 not in {r["bit"] for r in filed}
    for i, s in enumerate(seqs):
        own = sorted((r["u_at"], r["bit"], r["key"]) for r in filed if r["u_id"] == i)
        assert len(own) == candidates.edits(len(s), 0.95) + 1 and own[-1][0] + own[-1][1] <= len(s) - 150 + 16
        assert all(a + k <= b for (a, k, _), (b, _, _) in zip(own, own[1:]))
        assert all(key == int(candidates._codes(s[a : a + k].encode(), k)[0].view(np.int64)) for a, k, key in own)


def test_pairs_that_may_be_alike_are_kept_and_chance_ones_are_not():
    rng = random.Random(10)
    flank = made(rng, 150)
    us = [made(rng, n) for n in (0, 1, 5, 6, 7, 40, 80, 200)] + ["ACNNGTacgt\u00e9" * 6, "A" * 60] + [made(rng, 80) for _ in range(600)]
    vs = [mutated(rng, u, 0.06) for u in us]
    far = [edits(u, v) for u, v in zip(us, vs)]
    code = lambda xs: [x.encode() for x in xs]
    assert align.alike(code(us), code(vs), np.array(far)).all() and max(far) > 5
    us, vs = ([made(rng, 300) + flank for _ in range(50)] for _ in range(2))
    assert not align.alike(code(us), code(vs), np.full(50, 23)).any()


def test_of_one_length_the_lesser_is_first(spark):
    from sporeline.operators import graph

    rng = random.Random(11)
    seqs = [made(rng, 80) for _ in range(40)]
    rows = [s[:i] + c + s[i + 1 :] for s in seqs for i, c in ((30, "A"), (30, "T"), (50, "G"))]
    for definition, both in ((1, False), (2, True)):
        got = graph.matches(spark.createDataFrame([(s,) for s in rows], "seq string").repartition(7), 0.95, definition, 0.9, both).collect()
        assert len(got) >= 60 and all(len(r.u) == len(r.v) and r.u < r.v for r in got)


def test_a_narrow_band_is_believed_only_where_none_outside_can_be_better(monkeypatch):
    rng = random.Random(12)
    us, vs = [], []
    for i in range(400):
        u = made(rng, rng.randint(0, 120)) if i % 4 else rng.choice(["ACAC", "AAAA", "ACG"]) * rng.randint(0, 30)
        k = rng.randint(0, 40)
        us.append(u.encode())
        vs.append([mutated(rng, u, 0.05), u[k:] + made(rng, k), u[: k // 2] + made(rng, k) + u[k // 2 :], made(rng, k) + u[: len(u) - k]][i // 4 % 4].encode())
    low, high = np.array([-rng.choice([30, 45, 500]) for _ in us]), np.array([rng.choice([30, 45, 500]) for _ in us])
    runs, lots = [], align._lots
    want = lots(us, vs, low, high, align.Scoring())
    monkeypatch.setattr(align, "_lots", lambda *args: runs.append(args) or lots(*args))
    for near in (align.NEAR, 0, 4):
        monkeypatch.setattr(align, "NEAR", near)
        runs.clear()
        assert (align.align(us, vs, low, high) == want).all()
        assert len(runs) == 2 and 0 < len(runs[1][0]) < len(us)
