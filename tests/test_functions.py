from pyspark.sql import functions as F

from sporeline.functions import seq as S


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first().x


def test_homopolymers(spark):
    assert one(spark, S.homopolymer_cap(F.col("s"), 2), s="AACCCTTTTGGGGG") == "AACCTTGG"
    assert one(spark, S.homopolymer_cap(F.col("s"), 0), s="AACCCTTTTGGGGG") == "ACTG"
    assert one(spark, S.homopolymer_collapse(F.col("s")), s="AACCCTTTTGGGGG") == "ACTG"


def test_iupac(spark):
    assert one(spark, S.iupac_regex(F.col("s")), s="CGACCWGCGGARGGATCATTA") == "CGACC[AT]GCGGA[AG]GGATCATTA"
    assert len(list(S.iupac_expand("CCTSCSCTTANTDATATGC"))) == 48
    assert one(spark, S.iupac_variants(F.col("s"), 3), s="ARS") == ["AAC", "AAG", "AGC", "AGG"]


def test_revcomp_and_names(spark):
    assert one(spark, S.revcomp(F.col("s")), s="ACGTNRYacb") == "vgtRYNACGT"
    assert one(spark, S.safe_name(F.col("s")), s="E__F__G__H") == "E__F_G_H"
    assert one(spark, S.pure_acgt(F.col("s")), s="") is True


def test_uncross(spark):
    hit = one(spark, S.uncross(F.col("x"), F.lit(1000), F.lit(10), 0.01, 1.0), x=1)
    assert abs(hit - 0.5378828) < 1e-6
    assert one(spark, S.uncross(F.col("x"), F.lit(1000), F.lit(10), 0.01, 1.0), x=100) < 1e-40


def test_replicates_and_recovery(spark):
    from sporeline.operators import chimera, otu

    j = spark.createDataFrame([("o", "Run1__S1", 2), ("o", "Run2__S1", 3), ("o", "S9", 4)], "OTU string, SampleID string, Abundance long")
    assert {(r.SampleID, r.Abundance) for r in otu.long_table(j, True).collect()} == {("S1", 5), (None, 4)}
    r = spark.createDataFrame([("a", "x", "ACG", 0.7), ("b", "y", "ACG", None)], "SeqID string, SampleID string, Sequence string, DeNovo_Chimera_Score double")
    assert chimera.remove(r, 0.6).count() == 2 and chimera.remove(r, 0.6, recover=False).count() == 1


def test_empty_tables(spark):
    from sporeline.operators import cluster, graph, intervals, tagjump

    assert tagjump.scores(spark.createDataFrame([], "OTU string, SampleID string, Abundance long")).count() == 0
    assert intervals.merge(spark.createDataFrame([], "id string, start long, end long")).count() == 0
    assert graph.edit_links(spark.createDataFrame([], "seq string"), 1).count() == 0
    assert cluster.greedy(spark.createDataFrame([], "seq string, size long"), 0.97, 8, 4).count() == 0
