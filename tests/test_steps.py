import pytest

from sporeline.plans import steps

A, B = "ACGTTGCAACGTACGGTACAGGATCCAT", "TGCAACGTTGCATGCCATGTCCATTAGA"


def reads(spark):
    rows = [("s1", f"r{i}", A, "I" * 28) for i in range(8)] + [("s2", f"q{i}", B, "I" * 28) for i in range(6)]
    rows += [("s1", "n1", A[:-1] + "C", "I" * 28), ("s2", "bad", A, "#" * 28), ("s1", "ns", "N" * 28, "I" * 28)]
    return spark.createDataFrame(rows, "SampleID string, id string, seq string, qual string")


def test_step1_then_step2(spark):
    table = steps.step1(reads(spark), steps.Params(tj=False))
    cells = {(r.SampleID, r.Sequence): r.Abundance for r in table.collect()}
    assert cells == {("s1", A): 8, ("s1", A[:-1] + "C"): 1, ("s2", B): 6}
    out = steps.step2([table], steps.Params(otu_identity=0.95))
    long = sorted((r.SampleID, r.Abundance) for r in out["long"].collect())
    assert long == [("s1", 9), ("s2", 6)]
    assert out["membership"].count() == 3
    swarm = steps.step2([table], steps.Params(clustering="swarm", lulu=True))
    assert sorted(r.Abundance for r in swarm["long"].collect()) == [6, 9]


def test_trimming_by_degenerate_primers(spark):
    forward, reverse = "ACGTRYAC", "GGNCCATT"
    ends = ("ACGTACAC", "AATGGACC")  # concrete bases; the reverse primer's site is its reverse complement
    rows = []
    for sample, inner, left, right in (("s1", A, 0, 0), ("s2", B, 2, 0), ("s2", A, 0, 2)):
        read = (ends[0] + inner + ends[1])[left:]
        read = read[: len(read) - right]
        rows.append((sample, "same id", read, "#" * (8 - left) + "I" * 28 + "#" * (8 - right)))
        turned = read[::-1].translate(str.maketrans("ACGT", "TGCA"))
        rows.append((sample, "turned", turned, ("#" * (8 - left) + "I" * 28 + "#" * (8 - right))[::-1]))
    rows.append(("s1", "none", A, "I" * 28))
    df = spark.createDataFrame(rows, "SampleID string, id string, seq string, qual string")
    p = steps.Params(primer_forward=forward, primer_reverse=reverse, primer_mismatches=0, max_ee_rate=None, tj=False, homopolymers=False)
    cells = {(r.SampleID, r.Sequence): (r.Abundance, round(r.MaxEE, 6)) for r in steps.step1(df, p).collect()}
    ee = round(28 * 10 ** (-40 / 10), 6)  # of the trimmed read alone
    assert cells == {("s1", A): (2, ee), ("s2", B): (2, ee), ("s2", A): (2, ee)}


def test_singletons_of_poor_quality_go(spark):
    good = [("s1", f"r{i}", A, "I" * 28) for i in range(4)]
    rows = good + [("s1", "poor", B, "5" * 28), ("s2", "fine", B[::-1], "I" * 28)]
    table = steps.step1(spark.createDataFrame(rows, "SampleID string, id string, seq string, qual string"), steps.Params(tj=False, max_ee_rate=None))
    assert {r.Sequence: round(r.MEEP, 3) for r in table.collect()}[B] == 1.0
    keep = {r.SeqID for r in table.filter(f"Sequence <> '{B}'").collect()}
    assert {r.OTU for r in steps.step2([table], steps.Params(max_meep=0.5))["long"].collect()} == keep
    assert steps.step2([table], steps.Params(max_meep=2.0))["long"].count() == 3
    assert steps.step2([table], steps.Params(recover_singletons=False))["long"].count() == 1


def test_tag_jumps_are_judged_by_clusters(spark):
    rows = [("s1", f"r{i}", A, "I" * 28) for i in range(300)] + [("s2", "jump", A, "I" * 28)] + [("s2", f"q{i}", B, "I" * 28) for i in range(20)]
    cells = {(r.SampleID, r.Sequence) for r in steps.step1(spark.createDataFrame(rows, "SampleID string, id string, seq string, qual string")).collect()}
    assert ("s1", A) in cells and ("s2", B) in cells and ("s2", A) not in cells


def test_bad_parameters():
    with pytest.raises(ValueError):
        steps.Params(lulu=True, clustering="none")


def test_seqstats(spark):
    r = reads(spark)
    out = {x.file: (x.raw, x.qc, x.artefacts, x.artefact_bp) for x in steps.seqstats(r, r.filter("id <> 'bad'"), r.filter("id = 'n1'")).collect()}
    assert out == {"s1": (10, 10, 1, 1000), "s2": (7, 6, 0, 0)}


def test_near_copies_on_opposite_strands_are_one_otu(spark):
    import random

    rng = random.Random(3)
    inner = "".join(rng.choice("ACGT") for _ in range(98))
    a, b = "A" + inner + "T", "T" + inner + "T"  # their lesser strands differ
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [("s1", "1", a, 50), ("s2", "2", b, 5), ("s1", "3", turn(a), 4)]
    table = spark.createDataFrame([(s, f"q{i}", n, 40.0, 0.1, 0.1, None, q) for s, i, q, n in rows], "SampleID string, SeqID string, Abundance long, PhredScore double, MaxEE double, MEEP double, DeNovo_Chimera_Score double, Sequence string")
    out = steps.step2([table], steps.Params(otu_identity=0.98))
    cells = sorted((r.OTU, r.SampleID, r.Abundance) for r in out["long"].collect())
    assert cells == [("q1", "s1", 54), ("q1", "s2", 5)]
    assert {r.centroid for r in out["sequences"].collect()} == {a}


def test_homopolymers_are_corrected_on_both_strands(spark):
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [("s1", f"r{i}", A, "I" * 28) for i in range(5)] + [("s1", "run", A[:4] + A[3:], "I" * 29), ("s1", "turned", turn(A), "I" * 28), ("s2", "x", turn(A), "I" * 28)]
    table = steps.step1(spark.createDataFrame(rows, "SampleID string, id string, seq string, qual string"), steps.Params(tj=False))
    assert {(r.SampleID, r.Sequence): r.Abundance for r in table.collect()} == {("s1", A): 7, ("s2", turn(A)): 1}
