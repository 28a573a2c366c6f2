"""Chimera models against parents of other lengths, by plain Python."""

import random

import numpy as np

from sporeline.operators import models


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def made(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_alignment_has_fewest_edits():
    rng = random.Random(3)
    for _ in range(200):
        a = made(rng, rng.randint(1, 25))
        b = "".join(x for x in a if rng.random() > 0.2) + made(rng, rng.randint(1, 5))
        got = models._aligned(*models._bytes([a, b]))
        used = [chr(x) for x in got if x]
        left = iter(b)
        assert len(got) == len(a) and all(any(x == y for y in left) for x in used)
        if len(a) != len(b):
            missed = sum(x != y for x, y in zip(got, a.encode()))
            assert missed + len(b) - len(used) == edits(a, b)


def test_model_is_the_best_of_all():
    rng = random.Random(4)
    for _ in range(40):
        base = made(rng, 24)
        parents = [made(rng, rng.randint(0, 3)) + base[rng.randint(0, 3) : 24 - rng.randint(0, 3)] for _ in range(6)]
        q = parents[0][:9] + parents[1][-11:]
        rows = [models._aligned(models._bytes([q])[0], p).tobytes() for p in models._bytes(parents)]
        head = lambda p, c: sum(x == y for x, y in zip(q.encode()[: c + 1], p))
        tail = lambda p, c: sum(x == y for x, y in zip(q.encode()[: c : -1], p[::-1]))
        totals = [max(head(p, c) for p in rows) + max(tail(p, c) for p in rows) for c in range(len(q) - 1)]
        cut = totals.index(max(totals))
        a, b = (max(range(6), key=lambda i: (of(rows[i], cut), -i)) for of in (head, tail))
        want = (0.0, False) if a == b else models._votes(*models._bytes([q]), *(np.frombuffer(rows[i], np.uint8) for i in (a, b)), cut, 8.0, 1.4, 3, 0.8)
        assert models.model(models._bytes([q])[0], models._bytes(parents), 8.0, 1.4, 3, 0.8) == want


def all_parents(rows, abskew=2.0, minh=0.28):
    """Verdicts with every clean, more abundant sequence of the sample as a parent, one after another."""
    out = {}
    for sample in {s for s, _, _ in rows}:
        own = sorted(((q, n) for s, q, n in rows if s == sample and q), key=lambda x: (-x[1], x[0]))
        for q, n in own:
            able = [p for p, m in own if m >= abskew * n and not out[sample, p]]
            score, firm = models.model(models._bytes([q])[0], models._bytes(able), 8.0, 1.4, 3, 0.8)
            out[sample, q] = firm and score >= minh
    return out


def test_candidates_give_the_verdicts_of_all_parents(spark):
    """Families with a flank that all share, in a hot sample and a small one; chimeras of chimeras; indels before the crossing."""
    rng = random.Random(8)
    flank = made(rng, 60)
    founders = [made(rng, 120) + flank for _ in range(12)]
    near = lambda s: "".join(rng.choice([x for x in "ACGT" if x != c]) if i % 9 == 4 and i < 120 else c for i, c in enumerate(s))
    parents = founders + [near(s) for s in founders[:6]] + [s[:30] + "AC" + s[30:] for s in founders[6:9]]
    crossed = []
    for _ in range(25):
        a, b = rng.sample(parents, 2)
        cut = rng.randint(35, 90)
        crossed.append(a[:cut] + b[cut:])
    twice = [x[:50] + rng.choice(parents)[50:] for x in crossed[:8]]
    rows = [("hot", s, 500 - i) for i, s in enumerate(parents)] + [("hot", s, 40 - i % 7) for i, s in enumerate(crossed)] + [("hot", s, 3) for s in twice]
    rows += [("small", s, 90) for s in parents[:4]] + [("small", crossed[0], 2), ("small", crossed[0][:-1], 9)]
    rows = list({(s, q): (s, q, n) for s, q, n in rows}.values())
    df = spark.createDataFrame([*rows, ("hot", None, 4), (None, parents[0], 3), ("small", "", 2)], "SampleID string, seq string, size long")
    got = {(r.SampleID, r.seq): r.chimera for r in models.denovo_chimeras(df).collect()}
    want = all_parents(rows)
    assert {k: v for k, v in got.items() if k in want} == want and sum(want.values()) > 20
    assert got["hot", None] is got[None, parents[0]] is got["small", ""] is False and len(got) == len(rows) + 3
    asked = spark.createDataFrame([(s,) for s in [*crossed, *parents, None, crossed[0]]], "seq string")
    known = spark.createDataFrame([(s,) for s in parents], "seq string")
    verdicts = {}
    for q in {*crossed, *parents}:
        score, firm = models.model(models._bytes([q])[0], models._bytes(sorted(p for p in parents if p != q)), 8.0, 1.4, 3, 0.8)
        verdicts[q] = "clean" if score < 0.28 else "chimera" if firm else "borderline"
    got = [(r.seq, r.verdict) for r in models.reference_chimeras(asked, known).collect()]
    assert len(got) == len(crossed) + len(parents) + 2 and all(v == verdicts.get(q, "clean") for q, v in got)


def test_parents_of_other_lengths(spark):
    rng = random.Random(1)
    a = made(rng, 80)
    other = lambda s: "".join(rng.choice([x for x in "ACGT" if x != c]) if i % 6 == 0 else c for i, c in enumerate(s))
    b = other(a)
    longer = b[:60] + "ACG" + b[60:]
    crossed = a[:40] + longer[40:]
    variant = a[:50] + a[51:]
    rows = [("s", a, 100), ("s", longer, 90), ("s", crossed, 4), ("s", variant, 5), ("t", crossed, 4), ("t", a, 50)]
    out = {(r.SampleID, r.seq): r.chimera for r in models.denovo_chimeras(spark.createDataFrame(rows, "SampleID string, seq string, size long")).collect()}
    assert out == {(s, q): (s, q) == ("s", crossed) for s, q, _ in rows}

    known = spark.createDataFrame([(a,), (longer,), (crossed,), (None,), ("",)], "seq string")
    asked = spark.createDataFrame([(1, a), (2, crossed), (3, variant), (4, None), (5, ""), (6, "A"), (7, made(rng, 300))], "id long, seq string")
    got = {r.id: r.verdict for r in models.reference_chimeras(asked, known).collect()}
    assert got == {1: "clean", 2: "chimera", 3: "clean", 4: "clean", 5: "clean", 6: "clean", 7: "clean"}
    assert {r.verdict for r in models.reference_chimeras(asked, known, mindiv=90.0).filter("id = 2").collect()} == {"borderline"}
    assert {r.verdict for r in models.reference_chimeras(asked, known.filter("seq = 'x'")).collect()} == {"clean"}
