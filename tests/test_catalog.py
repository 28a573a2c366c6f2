import pytest

from sporeline.plans import catalog
from tests.oracle import rows_match

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, name):
    rows_match(spark, catalog.queries()[name], catalog.oracle_sql()[name], SF)


def test_buckets_are_balanced(spark):
    from sporeline.operators import buckets

    stats = spark.createDataFrame([(f"c{i}", 1, 10 + i * 7 % 13) for i in range(40)], "Cluster string, num_seqs long, sum_len long")
    loads = [r.sum_len for r in buckets.bucket_summary(stats, buckets.pack(stats, 4)).collect()]
    assert max(loads) - min(loads) <= 22 and sum(loads) == sum(r.sum_len for r in stats.collect())


def test_greedy_clusters_keep_their_bounds(spark):
    from sporeline.operators import cluster

    rows = [("ACGTACGT", 9), ("ACGTACGA", 3), ("ACGTACTA", 2), ("TTTTCCCC", 5), ("TTTTCCCG", 5), ("GGGGGGGG", 1)]
    out = {r.seq: r.centroid for r in cluster.greedy(spark.createDataFrame(rows, "seq string, size long"), 0.8).collect()}
    assert out == {"ACGTACGT": "ACGTACGT", "ACGTACGA": "ACGTACGT", "ACGTACTA": "ACGTACTA", "TTTTCCCC": "TTTTCCCC", "TTTTCCCG": "TTTTCCCC", "GGGGGGGG": "GGGGGGGG"}


def test_swarm_components(spark):
    from sporeline.operators import cluster

    rows = [("ACGT", 9), ("ACGA", 3), ("ACAA", 2), ("TTTT", 1), ("ACGN", 4)]
    out = {r.seq: r.centroid for r in cluster.swarm(spark.createDataFrame(rows, "seq string, size long")).collect()}
    assert out == {"ACGT": "ACGT", "ACGA": "ACGT", "ACAA": "ACGT", "TTTT": "TTTT"}


def test_denovo_chimera_is_found(spark):
    from sporeline.operators import models

    a, b = "ACGTTGCAACGTACGGTACA", "TGCAACGTTGCATGCCATGT"
    rows = [("s", a, 100), ("s", b, 90), ("s", a[:10] + b[10:], 3), ("s", "A" * 20, 2)]
    out = {r.seq: r.chimera for r in models.denovo_chimeras(spark.createDataFrame(rows, "SampleID string, seq string, size long")).collect()}
    assert out == {a: False, b: False, a[:10] + b[10:]: True, "A" * 20: False}


def test_samples_and_runs_come_from_the_table(spark, tmp_path):
    rows = [(i, f"text {i % 17}", [None, "it", "de", "en", "zh"][i % 5], [None, "src3", "src20", "a.b", "lab `x`"][i // 3 % 5]) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").toPandas().to_parquet(tmp_path / "documents.parquet")
    for name in ("union_runs", "unpivot_long"):
        rows_match(spark, catalog.queries()[name], catalog.oracle_sql()[name], str(tmp_path))
    wide = catalog.queries()["otu_wide"](spark, str(tmp_path))
    assert wide.columns == ["OTU", "a.b", "lab `x`", "src20", "src3", "null"]
    assert sum(sum(r[1:]) for r in wide.collect()) == 60


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def test_edit_links_are_all_pairs(spark):
    import random

    from sporeline.operators import graph

    rng = random.Random(4)
    seqs = {""}
    for _ in range(25):
        base = "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 14)))
        for _ in range(5):
            x = list(base)
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(x) + 1)
                x[at : at + rng.randrange(2)] = rng.choice(["", "A", "C", "G", "T"])
            seqs.add("".join(x))
    df = spark.createDataFrame([(x,) for x in sorted(seqs)], "seq string")
    of = {(a, b): distance(a, b) for a in seqs for b in seqs if a < b}
    for most in (1, 2, 3):
        got = {(r.u, r.v): r.distance for r in graph.edit_links(df, most).collect()}
        assert got == {k: n for k, n in of.items() if n <= most}


def sized(spark):
    from sporeline.plans import bind

    rows = bind.families(spark, SF).groupBy("seq").sum("size").collect()
    return dict(map(tuple, rows))


def brute_greedy(sizes, near, accept):
    """In order of size; near: (a, b) -> edits."""
    out = {}
    for q in sorted(sizes, key=lambda x: (-sizes[x], x)):
        found = [(n, -sizes[c], c) for c, n in near.get(q, {}).items() if out.get(c) == c and accept(q, c, n)]
        out[q] = min(found)[2] if found else q
    return out


def neighbours(sizes, most):
    near = {}
    for a in sizes:
        for b in sizes:
            if a < b and abs(len(a) - len(b)) <= most and (n := distance(a, b)) <= most:
                near.setdefault(a, {})[b] = near.setdefault(b, {})[a] = n
    return near


def test_clusters_are_brute_force(spark):
    sizes = sized(spark)
    near = neighbours(sizes, 4)
    run = lambda name: {r.seq: r.centroid for r in catalog.queries()[name](spark, SF).collect()}
    alike = lambda q, c, n: 1 - n / max(len(q), len(c)) >= 0.97 - 1e-12
    got = run("greedy_cluster")
    assert got == brute_greedy(sizes, near, alike) and len(set(got.values())) < len(got)
    assert run("unoise") == brute_greedy(sizes, near, lambda q, c, n: n <= 3 and sizes[q] / sizes[c] <= 2.0 ** -(2.0 * n + 1))
    # Swarms by breadth-first search.
    swarms, of = [], {}
    for x in sorted(sizes, key=lambda x: (-sizes[x], x)):
        if x not in of:
            members, todo = {x}, [x]
            while todo:
                new = [y for y, n in near.get(todo.pop(), {}).items() if n == 1 and y not in members]
                members.update(new)
                todo += new
            of.update(dict.fromkeys(members, x))
            swarms.append((x, members))
    assert run("swarm_d1") == of
    mass = {x: sum(sizes[y] for y in m) for x, m in swarms}
    for x, m in swarms:
        if mass[x] < 3:
            onto = [(-mass[of[z]], of[z]) for y in m for z, n in near.get(y, {}).items() if n <= 2 and mass[of[z]] >= 3]
            if onto:
                of = {**of, **dict.fromkeys(m, min(onto)[1])}
    assert run("swarm_fastidious") == of


def test_linclust_and_curation_keep_their_bounds(spark):
    sizes = sized(spark)
    out = {r.seq: r.centroid for r in catalog.queries()["linclust"](spark, SF).collect()}
    assert set(out) == set(sizes) and len(set(out.values())) < len(out)
    assert all(distance(a, b) <= 16 for a, b in out.items())
    cells = catalog.queries()["lulu_curate"](spark, SF).collect()
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr("sum(cast(l_quantity as bigint)) n", "count(distinct l_partkey) otus").first()
    assert sum(r.Abundance for r in cells) == lines.n and len({r.OTU for r in cells}) < lines.otus
