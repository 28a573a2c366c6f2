"""Profile search against a plain Viterbi, and regions from a profile's text."""

import random

import numpy as np

from sporeline.operators import intervals, profile
from tests.test_align import made, mutated


def plain(p, s):
    """The best path's score, base by base and node by node."""
    L, enter = p.length, -np.log2(p.length)
    M = [[profile.NEVER] * (L + 1) for _ in range(len(s) + 1)]
    I, D = [r[:] for r in M], [r[:] for r in M]  # noqa: E741
    t = lambda k: p.moves[k - 1]
    best = profile.NEVER
    for i in range(1, len(s) + 1):
        for k in range(1, L + 1):
            ways = [enter]
            if k > 1:
                ways += [M[i - 1][k - 1] + t(k - 1)[0], I[i - 1][k - 1] + t(k - 1)[3], D[i - 1][k - 1] + t(k - 1)[5]]
                D[i][k] = max(M[i][k - 1] + t(k - 1)[2], D[i][k - 1] + t(k - 1)[6])
            base = "ACGT".find(s[i - 1])
            M[i][k] = max(ways) + (p.match[k - 1][base] if base >= 0 else 0.0)
            I[i][k] = max(M[i - 1][k] + t(k)[1], I[i - 1][k] + t(k)[4])
            best = max(best, M[i][k])
    return best


def text_of(p):
    """A save file of a profile."""
    nats = lambda x: "*" if x <= profile.NEVER / 2 else f"{-x * np.log(2):.5f}"
    out = ["HMMER3/f [x]", f"NAME  {p.name}", f"LENG  {p.length}", "ALPH  DNA", "HMM          A        C        G        T", "  m->m m->i m->d i->m i->i d->m d->d", "  COMPO 1.3 1.3 1.3 1.3", "  1.38 1.38 1.38 1.38", "  0.01 5 5 0.5 0.9 0 *"]
    for k in range(p.length):
        out += [f"  {k + 1} " + " ".join(nats(x - 2) for x in p.match[k]) + f" {k + 1} x - - -", "  1.38 1.38 1.38 1.38", "  " + " ".join(map(nats, p.moves[k]))]
    return "\n".join([*out, "//", ""])


def test_scores_equal_a_plain_viterbi():
    rng = random.Random(1)
    for _ in range(25):
        consensus = made(rng, rng.randint(2, 14))
        p = profile.of_consensus("p", consensus, gap=0.05)
        p.match += np.array([[rng.uniform(-1, 1) for _ in range(4)] for _ in range(p.length)])
        p.moves += np.array([[rng.uniform(-1, 0) for _ in range(7)] for _ in range(p.length)])
        seqs = [made(rng, rng.randint(0, 6)) + mutated(rng, consensus, 0.2) + made(rng, rng.randint(0, 6)) for _ in range(6)] + ["A", "NNN", consensus]
        got = profile.best_paths(p, [s.encode() for s in seqs])
        for s, (score, start, end, a, b) in zip(seqs, got):
            assert abs(score - plain(p, s)) < 1e-6, s
            assert 1 <= start <= end <= len(s) and 1 <= a <= b <= p.length
            # The path's own stretch scores the same.
            assert abs(plain(p, s[start - 1 : end]) - score) < 1e-6


def test_regions_from_a_profile(spark, tmp_path):
    rng = random.Random(2)
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    anchors = {n: made(rng, 30) for n in ("SSU_end", "S58_start", "S58_end", "LSU_start")}
    made_ = [profile.of_consensus(n, s) for n, s in anchors.items()]
    (tmp_path / "set.hmm").write_text("".join(map(text_of, made_)))
    read = profile.read_profiles(spark, str(tmp_path / "set.hmm"))
    assert [p.name for p in read] == list(anchors)
    assert all(np.allclose(a.match, b.match, atol=1e-4) and np.allclose(a.moves, b.moves, atol=1e-4) for a, b in zip(made_, read))
    its1, its2 = made(rng, 70), made(rng, 90)
    whole = made(rng, 20) + anchors["SSU_end"] + its1 + anchors["S58_start"] + made(rng, 50) + anchors["S58_end"] + its2 + anchors["LSU_start"] + made(rng, 15)
    damaged = whole.replace(anchors["S58_end"], anchors["S58_end"][:12] + "T" + anchors["S58_end"][14:])
    rows = [("a", whole), ("b", turn(whole)), ("c", damaged), ("d", its1), ("e", None), ("f", whole[150:])]
    df = spark.createDataFrame(rows, "id string, seq string")
    out = {r.id: r for r in profile.regions(df, read).collect()}
    for i in "ab":
        r = out[i]
        assert r.strand == "+-"[i == "b"] and (r.ITS1, r.ITS2, r.SSU) == ("ITS1: 51-120", "ITS2: 231-320", "SSU: 1-50") and r.LSU == f"LSU: 321-{len(whole)}"
    assert out["c"].ITS2.startswith("ITS2: ") and out["c"].ITS2.endswith("-319") and out["f"].ITS1 == "ITS1: Not found" and "e" not in out and "d" not in out
    from pyspark.sql import functions as F

    read_ = profile.regions(df.filter("id = 'a'"), read).select(intervals.parse_region(F.col("ITS1"), "ITS1", F.col("length")).alias("r")).select("r.*").first()
    assert (read_.start, read_.end) == (51, 120)


def test_search_carries_beginnings_along_only_near_good_ends(monkeypatch):
    """The search has the paths of ``best_paths`` over whole sequences, for which it looks at as much as such a path can reach."""
    rng = np.random.default_rng(9)
    letters = np.frombuffer(b"ACGTN", np.uint8)
    p = profile.of_consensus("a", "ACCTGCGGAAGGATCATTA")
    core = b"ACCTGCGGAAGGATCATTA"
    inner = [core, core[:9] + b"GT" + core[9:], core[:6] + core[9:], b"ACCTGCGGAANGATCAT", b"", core + b"T" * 40 + core]
    seqs = [rng.choice(letters, rng.integers(0, 120)).tobytes() + x + rng.choice(letters, rng.integers(0, 120)).tobytes() for x in inner * 20]
    strange = profile.Profile("b", p.match, np.where(p.moves == p.moves[0, 6], profile.NEVER, p.moves))
    whole, seen = profile.best_paths, []
    monkeypatch.setattr(profile, "best_paths", lambda p, s: seen.extend(map(len, s)) or whole(p, s))
    for own in (p, strange):
        for least in (18.0, 6.0, 0.5):
            seen.clear()
            found = profile._found(own, seqs, least)
            assert found == [(i, x) for i, x in enumerate(whole(own, seqs)) if x[0] >= least]
            assert len(seen) == len(found) and max(seen) <= profile.reach(own, least)
    assert profile._found(p, [], 1.0) == [] and profile.best_ends(p, [b""])[1].tolist() == [0]
