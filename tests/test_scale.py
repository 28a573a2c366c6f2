"""Plans and intermediate rows that have to stay small as tables grow."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from sporeline.operators import barcodes, candidates, cluster, denoise, graph, intervals, models, otu, tagjump, tags


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_trimming_finds_each_span_once(spark):
    reads = spark.createDataFrame([(1, "AATTACGGGCCCCCCCCCCGTAACC"), (2, "GGTTACGGGGGGGGGGCCCGTAATT"), (3, "")], "id long, seq string")
    out = tags.trim(reads.withColumn("seq", F.upper("seq")), "TTACG", "GTTACG", 0, 5)
    assert plan(out).count("zip_with") <= 4
    assert {r.id: r.seq for r in out.collect()} == {1: "GGCCCCCCCCC", 2: "GGCCCCCCCCC"}


def test_audit_reads_each_coordinate_once_under_conditions(spark):
    seqs = spark.createDataFrame([(1, "ACGT" * 20)], "id long, seq string")
    told = spark.createDataFrame([(1, "80 bp.", None, "SSU: 1-9", "ITS1: 10-20", "5.8S: 21-40", "ITS2: 41-60", "LSU: 61-80")], "id long, length string, info string, SSU string, ITS1 string, S58 string, ITS2 string, LSU string")
    audited = intervals.audit(seqs, told)
    for out in (intervals.reason_histogram(audited), intervals.extract(audited)):
        assert plan(out).count("regexp_extract") <= 10
    assert intervals.extract(audited).first().region_seq == ("ACGT" * 20)[9:60]


def test_bits_of_windows_are_never_broadcast(spark, tmp_path):
    spark.range(50).select(F.col("id").alias("row"), F.lit("ACGTACCTGATC" + "A" * 40).alias("seq")).write.parquet(str(tmp_path / "reads"))
    known = spark.createDataFrame([("t0", "ACGTACCTGATC")], "tag string, seq string")
    out = barcodes.calls(spark.read.parquet(str(tmp_path / "reads")), known, window=40)
    assert "rightHint=(strategy=broadcast)" in plan(out)
    assert out.count() == 50


def random_seqs(n, length, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("ACGT") for _ in range(length)) for _ in range(n)]


def test_rates_are_of_alike_sequences_of_a_bucket(spark):
    seqs = random_seqs(400, 80, 1)
    near = [s[:40] + ("A" if s[40] != "A" else "C") + s[41:] for s in seqs]
    rows = [("ab"[i % 2], s, 50) for i, s in enumerate(seqs)] + [("ab"[i % 2], s, 2) for i, s in enumerate(near)]
    got = denoise.links(spark.createDataFrame(rows, "bucket string, seq string, size long"))
    want = {("ab"[i % 2], b, a) for i, (a, b) in enumerate(zip(seqs, near))}
    assert {(r.bucket, r.seq, r.centre) for r in got.collect()} == want


def test_groups_lose_no_pair_of_their_own(spark):
    seqs = random_seqs(60, 60, 2)
    near = [s[:20] + s[21:] for s in seqs]
    rows = [(s, g) for i, (a, b) in enumerate(zip(seqs, near)) for s, g in ((a, i % 3), (b, 0), (b, 1))]
    groups = spark.createDataFrame(rows, "seq string, bucket int")
    got = {frozenset((r.u, r.v)) for r in candidates.pairs(groups.select("seq").distinct(), 0.95, groups=groups).collect()}
    for i, (a, b) in enumerate(zip(seqs, near)):
        assert (frozenset((a, b)) in got) == (i % 3 < 2)


def test_bits_that_no_one_files_are_not_looked_up(spark):
    seqs = random_seqs(300, 80, 3)
    filed = spark.createDataFrame([(int(candidates._codes(s.encode(), 12)[5].view("int64")),) for s in seqs[:30]], "key long")
    there = spark.sparkContext.broadcast(candidates.marks(filed))
    rows = spark.createDataFrame(list(enumerate(seqs)), "id long, seq string")
    got = rows.mapInArrow(candidates._look({12: 1}, there), "key long, v_id long, v_at int").collect()
    assert {(i, 5) for i in range(30)} <= {(r.v_id, r.v_at) for r in got} and len(got) < 100


def test_bits_of_chunks_grow_with_the_parents():
    assert models.bits_of(80) == models.bits_of(80, 10) and {k for *_, k in models.bits_of(80)} == {5}
    for length in (3, 20, 80, 300):
        for bases in (10**6, 10**12):
            for first, last, bits, k in models.bits_of(length, bases):
                assert bits >= 1 and bits * k <= last - first
    assert {k for *_, k in models.bits_of(80, 15_000 * 80)} == {11}


def test_sequences_do_not_travel_with_their_kmers(spark):
    seqs = random_seqs(40, 60, 4)
    rows = spark.createDataFrame([(s,) for s in seqs + [s[:30] for s in seqs]], "seq string")
    out = graph.kmer_links(rows, 12, 8)
    assert {(r.u, r.v, r.shared) for r in out.collect()} == {(s[:30], s, 19) for s in seqs}
    assert plan(out).count("Project [id#") >= 2  # the links' rows hold numbers and bits alone


def test_sparse_wide_table_is_the_wide_one(spark):
    long = spark.createDataFrame([(1, "a", 2), (1, "a", 3), (1, "B", 0), (2, None, 7), (None, "a", 1), (3, "a", None)], "OTU long, SampleID string, Abundance long")
    names = ["B", "a", None]
    wide = tagjump.from_wide(otu.wide_table(long, names), "OTU", ["B", "a", "null"])
    got = tagjump.from_sparse_wide(otu.sparse_wide_table(long), "OTU")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(got) == key(wide) and got.count() == 3


def test_kmers_are_never_broadcast(spark):
    assert "strategy=merge" in plan(graph.kmer_links(spark.createDataFrame([("ACGT" * 5,)], "seq string"), 12, 8))


def test_overlaps_keep_sequences_out_of_their_kmers(spark, monkeypatch):
    written, settled = [], graph.settled
    monkeypatch.setattr(graph, "settled", lambda df: written.append(df.columns) or settled(df))
    seqs = random_seqs(20, 60, 5)
    rows = spark.createDataFrame([(s,) for s in seqs + [s[1:] + "A" for s in seqs]], "seq string")
    got = {(r.u, r.v) for r in cluster.overlap_links(rows).collect()}
    assert got == {x for s in seqs for x in ((s, s[1:] + "A"), (s[1:] + "A", s))}
    assert [c for c in written if "kmer" in c] and not [c for c in written if "kmer" in c and "seq" in c]


def test_pairs_are_told_both_ways_from_the_samples_in_common(spark):
    """By brute force, with pairs of one way, twice the same, of oneself, without samples in common and without cells; nothing
    is divided by a query's 0. Samples of one side alone are no rows of a join: there is no outer join with cells."""
    rng = random.Random(4)
    own = {(o, s): rng.randrange(0, 5) for o in range(6) for s in range(12) if rng.random() < (0.2 + 0.15 * o)} | {(7, 99): 3}
    pairs = [(a, b) for a in range(6) for b in range(6) if (a * 5 + b) % 3] + [(0, 1), (2, 2), (7, 0), (0, 7), (0, 8), (8, 0), (None, 1), (1, None)]
    cells = spark.createDataFrame([(o, s, n) for (o, s), n in own.items()], "OTU long, SampleID long, Abundance long")
    found = cluster.pair_stats(cells, spark.createDataFrame(pairs, "query long, parent long"))
    want = {}
    for q, p in set(pairs):
        of = lambda o: {s: n for (x, s), n in own.items() if x == o}
        a, b = of(q), of(p)
        if not a or not b:
            continue
        times, both = pairs.count((q, p)), [(a[s], b[s]) for s in a if s in b]
        r = [y / x for x, y in both if x]
        want[q, p] = (len(a) * times, len(both) * times, min(r, default=None), max(r, default=None), round(sum(r) / len(both), 9) if r else None, sum(a.values()), sum(b.values()), len(both) / len(a))
    got = {(r["query"], r["parent"]): (r.query_spread, r.overlap, r.min_ratio, r.max_ratio, None if r.avg_ratio is None else round(r.avg_ratio, 9), r.query_total, r.parent_total, r.cooccurrence) for r in found.collect()}
    assert got == want and any(x[1] == 0 for x in got.values())


def test_edits_are_counted_once_and_only_filed_lengths_are_looked_up(spark, monkeypatch):
    looked, look, runs, file = [], candidates._look, [], candidates._file
    monkeypatch.setattr(candidates, "_file", lambda *args: runs.append(file(*args)) or runs[-1])
    monkeypatch.setattr(candidates, "_look", lambda least, filed=None: looked.append(sorted(least)) or look(least, filed))
    rng = random.Random(8)
    base = ["".join(rng.choices("ACGT", k=80)) for _ in range(30)]
    rows = spark.createDataFrame([(x,) for x in {*base, *(b[:40] + b[41:] for b in base)}], "seq string")
    links = graph.similar(rows, 0.95)
    assert {(r.u, r.v) for r in links.collect()} == {tuple(sorted((b, b[:40] + b[41:]))) for b in base}
    assert plan(links).count("levenshtein(") == 1
    batch = pa.RecordBatch.from_pydict({"id": list(range(60)), "seq": [r.seq for r in rows.collect()]})
    assert looked == [sorted({k for b in runs[0](iter([batch])) for k in b.column("bit").to_pylist()})]
