import gzip

import pytest
from pyspark.sql import functions as F

from sporeline.functions import seq as S
from sporeline.operators import relational
from sporeline.sources import sinks


def cells(spark):
    rows = [("o1", "s1", 5), ("o1", "s2", 2), ("o2", "s2", 9), ("o3", None, 1), ("o2", "s3", 4), ("o4", "s3", 0)]
    return spark.createDataFrame(rows, "OTU string, SampleID string, Abundance long")


def test_wide_text_in_folders_and_files(spark, tmp_path):
    folders = sinks.write_wide(cells(spark), str(tmp_path / "w"), cells=6, samples=2)
    assert [f.rsplit("/", 1)[1] for f in folders] == ["samples-000", "samples-001"]
    got = {}
    for f in folders:
        files = sorted((tmp_path / "w" / f.rsplit("/", 1)[1]).glob("*.csv.gz"))
        lines = [x.split("\t") for p in files for x in gzip.open(p, "rt").read().splitlines()]
        assert len(files) >= 2 and lines[0][0] == "OTU"
        rows = [x for x in lines if x[0] != "OTU"]
        assert [x[0] for x in rows] == ["o2", "o1", "o3", "o4"]
        for x in rows:
            got.update({(x[0], name): int(v) for name, v in zip(lines[0][1:], x[1:])})
    assert got == {(o, s): n for o in ("o1", "o2", "o3", "o4") for s, n in zip(("s1", "s2", "s3", "null"), {"o1": (5, 2, 0, 0), "o2": (0, 9, 4, 0), "o3": (0, 0, 0, 1), "o4": (0, 0, 0, 0)}[o])}


def test_sparse_matrix(spark, tmp_path):
    sinks.write_sparse(cells(spark), str(tmp_path / "m"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "m" / "matrix").glob("part-*"))).splitlines()
    assert text[0].startswith("%%MatrixMarket matrix coordinate") and text[1] == "2 3 4"
    names = lambda kind: dict(x.split("\t") for p in sorted((tmp_path / "m" / kind).glob("part-*")) for x in p.read_text().splitlines())
    rows, columns = names("rows"), names("columns")
    assert {(rows[i], columns[j], int(n)) for i, j, n in (x.split() for x in text[2:])} == {("o1", "s1", 5), ("o1", "s2", 2), ("o2", "s2", 9), ("o2", "s3", 4)}
    with pytest.raises(ValueError, match="cells"):
        sinks.require_dense(cells(spark), 3)


def test_keyed_table_csv_and_versions(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    spark.sql("DROP TABLE IF EXISTS keyed_for_test")
    sinks.write_keyed(rows, "keyed_for_test", "id")
    sinks.write_keyed(rows.filter("id = 2"), "keyed_for_test", "id")
    assert [tuple(r) for r in spark.table("keyed_for_test").collect()] == [(2, "b")]
    with pytest.raises(ValueError, match="key"):
        sinks.write_keyed(rows.union(rows), "keyed_for_test", "id")
    assert spark.table("keyed_for_test").count() == 1
    spark.sql("DROP TABLE keyed_for_test")
    (tmp_path / "x.csv").write_text("1,a\n2,\n")
    assert [tuple(r) for r in sinks.read_csv(spark, str(tmp_path / "x.csv"), "a int, b string").collect()] == [(1, "a"), (2, None)]
    found = spark.createDataFrame([("p2", "b", "1.0"), ("p1", "z", "2"), ("p1", "a", "3"), ("p2", "b", "1.0")], "process string, tool string, version string")
    sinks.write_versions(found, str(tmp_path / "v"))
    assert next((tmp_path / "v").glob("part-*")).read_text() == '"p1":\n    a: 3\n    z: 2\n"p2":\n    b: 1.0\n'


def test_names_and_offenders(spark):
    df = spark.createDataFrame([(" Łódź  ß--2__x__y ",), ("Æ.b",), (None,)], "n string")
    assert [r.n for r in df.select(S.safe_name(F.col("n")).alias("n")).collect()] == ["Lodz_ss_2__x_y", "AE_b", None]
    tags = spark.createDataFrame([("a b", "ACGT", "AC"), ("a_b", "ACGT", "AC"), ("c", "AXGT", "ACGT"), ("d", None, None), ("PosC", "ACGG", "TTTT")], "sample string, tag1 string, tag2 string")
    got = {(r.severity, r.check, r.sample) for r in relational.tag_findings(tags).collect()}
    assert got == {
        ("error", "repeated_name", "a b"), ("error", "repeated_name", "a_b"), ("error", "repeated_pair", "a b"), ("error", "repeated_pair", "a_b"), ("error", "odd_characters", "c"),
        ("error", "no_tag", "d"), ("warning", "odd_length", "a b"), ("warning", "odd_length", "a_b"), ("warning", "renamed", "a b"), ("warning", "no_control", None),
    }
    with pytest.raises(ValueError, match="no_tag: d"):
        relational.require_valid(tags)
    assert relational.require_valid(tags.filter("sample = 'PosC'")).count() == 1


def test_best_reads_have_the_least_errors(spark):
    rows = [(2, "AC", "II"), (1, "AC", "I#"), (3, "AC", "II"), (4, "G", None)]
    df = spark.createDataFrame(rows, "id long, seq string, qual string")
    assert sorted((r.seq, r.size, r.id) for r in relational.best_reads(df).collect()) == [("AC", 3, 2), ("G", 1, 4)]
    assert [r.id for r in relational.by_meep(df).collect()] == [2, 3, 1, 4]
