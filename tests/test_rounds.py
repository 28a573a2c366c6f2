"""Curation, swarms with breaking, packing, merging by quality and running sums against plain Python."""

import math
import random

from pyspark.sql import functions as F

from sporeline.operators import buckets, cluster, derep, ranks, relational


def test_curation_equals_a_sequential_version(spark):
    rng = random.Random(1)
    for kind, cooc, ratio, hits in (("min", 0.8, 1.0, None), ("avg", 0.6, 1.5, 3)):
        cells = {(f"o{o}", f"s{s}"): rng.randint(1, 40) for o in range(30) for s in range(6) if rng.random() < 0.6}
        pairs = {(a, b): rng.choice([0.9, 0.95, 0.97]) for a in {o for o, _ in cells} for b in {o for o, _ in cells} if a != b and rng.random() < 0.3}
        of = lambda o: {s: n for (x, s), n in cells.items() if x == o}
        rank = {o: (-len(of(o)), -sum(of(o).values()), o) for o, _ in cells}
        root = {}
        for o in sorted(rank, key=rank.get):
            root[o] = o
            own = sorted(((-i, rank[b], b) for (a, b), i in pairs.items() if a == o))[:hits]
            for _, _, b in own:
                both = [of(b)[s] / n for s, n in of(o).items() if s in of(b)]
                if rank[b] < rank[o] and len(both) / len(of(o)) >= cooc and both and (min(both) if kind == "min" else sum(both) / len(both)) > ratio:
                    root[o] = root[b]
                    break
        df = spark.createDataFrame([(*k, n) for k, n in cells.items()], "OTU string, SampleID string, Abundance long")
        links = spark.createDataFrame([(*k, i) for k, i in pairs.items()], "query string, parent string, identity double")
        got = {r.OTU: r.parent for r in cluster.curate(df, links, cooc, ratio, kind, hits).collect()}
        assert got == root and len(set(root.values())) < len(root)


def test_swarms_break_at_valleys(spark):
    rng = random.Random(2)
    sizes = {}
    for _ in range(6):
        s = "".join(rng.choice("ACGT") for _ in range(12))
        for _ in range(14):
            sizes.setdefault(s, rng.choice([1, 2, 3, 5, 20, 50]))
            at = rng.randrange(12)
            s = s[:at] + rng.choice("ACGT") + s[at + 1 :]
    near = lambda a, b: len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1
    left, want = sorted(sizes, key=lambda x: (-sizes[x], x)), {}
    for seed in list(left):
        if seed in want:
            continue
        want[seed], todo = seed, [seed]
        while todo:
            u = todo.pop()
            for v in left:
                if v not in want and near(u, v) and sizes[v] <= sizes[u]:
                    want[v] = seed
                    todo.append(v)
    df = spark.createDataFrame(list(sizes.items()), "seq string, size long")
    got = {r.seq: r.centroid for r in cluster.swarm(df, breaking=True).collect()}
    whole = {r.seq: r.centroid for r in cluster.swarm(df).collect()}
    assert got == want and len(set(got.values())) > len(set(whole.values()))


def test_small_clusters_fill_to_one_level(spark):
    rng = random.Random(3)
    sizes = [rng.randint(1, 9) for _ in range(400)] + [300, 200, 90, 90, 40]
    stats = spark.createDataFrame([(f"c{i}", 1, n) for i, n in enumerate(sizes)], "Cluster string, num_seqs long, sum_len long")
    packed = buckets.pack(stats, 6, head=5)
    assert packed.select("Cluster").distinct().count() == packed.count() == len(sizes)
    loads = {r.BucketID: r.sum_len for r in buckets.bucket_summary(stats, packed).collect()}
    assert max(loads.values()) <= max(300, (sum(sizes) - 300) / 5) + 9 + 1
    light = sorted(loads.values())[:5]
    assert light[-1] - light[0] <= 2 * 9


def test_running_sums_with_ties_in_all_rows(spark):
    rows = [(7, i, i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "lead long, id long, n long").repartition(7)
    out = {r.id: r.before for r in ranks.running(df, [F.col("lead"), F.col("id")], F.col("n")).collect()}
    total = 0
    for _, i, n in rows:
        assert out[i] == total
        total += n
    ranked = {r.OTU: r.rank for r in relational.ranks(df.select(F.col("id").alias("OTU"), F.lit(1).alias("total"))).collect()}
    assert ranked == {i: i + 1 for i in range(1000)}
    named = ranks.global_rank(df.select(F.format_string("same-prefix-%04d", "id").alias("name")), "name").collect()
    assert {r.name: r.rank for r in named} == {f"same-prefix-{i:04d}": i + 1 for i in range(1000)}


def test_pairs_merge_by_quality(spark):
    rng = random.Random(4)
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows, want = [], {}
    for i in range(30):
        whole = "".join(rng.choice("ACGT") for _ in range(90))
        r1, r2 = list(whole[:60]), list(whole[30:])
        q1, q2 = ([rng.randint(0, 40) for _ in range(60)] for _ in range(2))
        for at in rng.sample(range(30, 60), 2):
            r1[at] = rng.choice([c for c in "ACGT" if c != whole[at]])
        if i % 10 == 9:
            r2 = [rng.choice("ACGT") for _ in r2]
        seq, qual = "", ""
        for at in range(90):
            a = (r1[at], q1[at]) if at < 60 else None
            b = (r2[at - 30], q2[at - 30]) if at >= 30 else None
            if a and b:
                p, q = (10 ** (-x[1] / 10) for x in (a, b))
                e = p * q / 3 / (1 - p - q + 4 * p * q / 3) if a[0] == b[0] else min(p, q) * (1 - max(p, q) / 3) / (p + q - 4 * p * q / 3)
                seq += a[0] if p <= q else b[0]
                qual += chr(33 + min(41, int(math.floor(-10 * math.log10(e) + 0.5 + 1e-12))))
            else:
                x = a or b
                seq, qual = seq + x[0], qual + chr(33 + x[1])
        text = lambda q: "".join(chr(33 + x) for x in q)
        rows.append((i, "".join(r1), text(q1), turn("".join(r2)), text(q2)[::-1]))
        want[i] = (seq, qual, 30, True) if i % 10 != 9 else (None, None, None, False)
    rows.append((99, "ACGT", "IIII", None, None))
    df = spark.createDataFrame(rows, "id long, r1 string, q1 string, r2 string, q2 string")
    got = {r.id: (r.seq, r.qual, r.overlap, r.merged) for r in cluster.merge_pairs_by_quality(df, least=25, most_diff=3).collect()}
    assert got == {**want, 99: (None, None, None, False)}


def test_homopolymer_correction_with_repeated_ids(spark):
    rows = [(1, "AAC", 1), (1, "AACC", 1), (2, "GGT", 1)]
    out = sorted(map(tuple, derep.correct_homopolymers(spark.createDataFrame(rows, "id long, seq string, size long")).collect()))
    assert out == [(1, "AAC", 2), (2, "GGT", 1)]


def test_sample_keeps_groups_of_one(spark):
    df = spark.createDataFrame([("a",)] * 500 + [("b",), (None,)], "g string")
    got = [r.g for r in buckets.sample(df, "g", 0.1).collect()]
    assert got.count("b") == 1 and got.count(None) == 1 and 20 < got.count("a") < 90
    assert buckets.bucket_count(10**6, 5000) == 3 and buckets.bucket_count(0, 10) == 1


def test_islands_of_one_id_over_many_ranges(spark):
    from sporeline.operators import intervals

    rng = random.Random(6)
    rows = [("hot", a, a + rng.randint(0, 30)) for a in (rng.randint(0, 20_000) for _ in range(1500))] + [("hot", 5, 9000)]
    rows += [(i, a, a + 3) for i in ("b", None) for a in (1, 1, 4, 9, 13)]
    want = []
    for i in ("hot", "b", None):
        islands = []
        for a, b in sorted((a, b) for x, a, b in rows if x == i):
            if islands and a <= islands[-1][1]:
                islands[-1][1:] = max(b, islands[-1][1]), islands[-1][2] + 1
            else:
                islands.append([a, b, 1])
        want += [(i, *x) for x in islands]
    df = spark.createDataFrame(rows, "id string, start long, end long").repartition(5)
    got = [(r.id, r.start, r.end, r.n) for r in intervals.merge(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(want) > 50
