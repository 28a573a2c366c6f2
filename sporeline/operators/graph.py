"""Similarity links and their components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sporeline.functions import seq as S


def settled(df: DataFrame) -> DataFrame:
    """df, written once to the checkpoint folder that all executors share, and read from there."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "/tmp/sporeline-checkpoints"
    path = f"{base.rstrip('/')}/graph-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _once(value: Column) -> Column:
    """A row's value as the only one of a list: a filter on it can't be pushed below, where it would be taken a second time."""
    return F.explode(F.array(value))


def edit_links(seqs: DataFrame, most: int) -> DataFrame:
    """(u, v, distance), u < v: all pairs of distinct seqs(seq) at most ``most`` edits apart, among the pairs that share one of
    the rarest bits of the shorter one (see ``candidates``)."""
    from sporeline.operators import candidates

    met = candidates.pairs(seqs, 1.0, most=most).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    return met.select("u", "v", _once(F.levenshtein("u", "v", most)).alias("distance")).filter("distance >= 0")


def kmer_links(seqs: DataFrame, k: int, least: int) -> DataFrame:
    """(u, v, shared), u < v: pairs of distinct sequences with at least ``least`` distinct k-mers in common."""
    # Numbers meet, not sequences: chance alone makes far more pairs than there are links.
    numbered = settled(seqs.select("seq").withColumn("id", F.monotonically_increasing_id()))
    keyed = numbered.select("id", F.explode(F.array_distinct(S.kmers(F.col("seq"), k))).alias("kmer"))
    # The files' size says nothing of the k-mers', so neither side may be taken for small.
    met = keyed.select(F.col("id").alias("a"), "kmer").join(keyed.select(F.col("id").alias("b"), "kmer").hint("merge"), "kmer").filter("a < b")
    pairs = met.groupBy("a", "b").agg(F.count("*").alias("shared")).filter(F.col("shared") >= least)
    of = lambda side, name: numbered.select(F.col("id").alias(side), F.col("seq").alias(name))
    out = pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").filter("x <> y")
    return out.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"), "shared")


def identity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length."""
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def similar(seqs: DataFrame, least_identity: float) -> DataFrame:
    """(u, v, identity), u < v: all pairs of distinct seqs(seq) whose edit identity is at least ``least_identity``."""
    from sporeline.operators import candidates

    met = candidates.pairs(seqs, least_identity)
    most = F.floor((1 - least_identity) * F.greatest(F.length("u"), F.length("v")) + 1e-9).cast("int")
    close = met.withColumn("_most", most).withColumn("edits", _once(F.expr("levenshtein(u, v, _most)"))).filter(F.col("edits") >= 0)
    out = close.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "edits")
    return out.select("u", "v", (F.lit(1.0) - F.col("edits") / F.greatest(F.length("u"), F.length("v"))).alias("identity"))


def matches(seqs: DataFrame, least_identity: float, definition: int = 2, coverage: float = 0.9, both_strands: bool = False) -> DataFrame:
    """(u, v, strand, identity, u_coverage, v_coverage) of distinct seqs(seq), u the shorter, or of one length the lesser: all
    pairs whose global alignment with affine gaps has at least ``least_identity`` by definition 1 or 2 and aligns ``coverage``
    of u (definition 1 needs no coverage: its end gaps count). A pair that is alike on both strands is given on the better
    one, then on '+'.
    """
    from sporeline.operators import align, candidates

    met = candidates.pairs(seqs, least_identity, 1.0 if definition == 1 else coverage, both_strands)
    tasks = max(seqs.sparkSession.sparkContext.defaultParallelism, int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    done = align.aligned(met.repartition(tasks, "u", "v"), least=least_identity if definition == 1 else None).withColumn("identity", align.identity(definition))
    done = done.withColumns({"u_coverage": F.col("aligned") / F.length("u"), "v_coverage": F.col("aligned") / F.length("v")})
    if definition == 2:
        done = done.filter(F.col("u_coverage") >= coverage - 1e-12)
    done = done.filter(F.col("identity") >= least_identity - 1e-12)
    if both_strands:
        given = F.when(F.col("strand") == "-", S.revcomp(F.col("u"))).otherwise(F.col("u"))
        done = done.withColumn("u", given).filter("u <> v").groupBy("u", "v").agg(F.min(F.struct(-F.col("identity"), "strand", "identity", "u_coverage", "v_coverage")).alias("b"))
        done = done.select("u", "v", "b.strand", "b.identity", "b.u_coverage", "b.v_coverage")
    # Numbers chose the first of two of one length, and they differ from run to run; nothing else of the row depends on it.
    even = F.length("u") == F.length("v")
    u, v = (F.when(even, of("u", "v")).otherwise(F.col(side)).alias(side) for of, side in ((F.least, "u"), (F.greatest, "v")))
    return done.select(u, v, "strand", "identity", "u_coverage", "v_coverage")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root): the least node that links reach; nodes(node), links(u, v).

    Each round takes the least root among neighbours and follows roots of roots, so rounds number about the logarithm of
    the longest path; a round's result is written, which also cuts lineage.
    """
    both = settled(links.select("u", "v").union(links.select(F.col("v"), F.col("u"))).distinct())
    now = settled(nodes.select("node", F.col("node").alias("root")))
    while True:
        near = both.join(now.select(F.col("node").alias("v"), "root"), "v").groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near"))
        step = now.join(near, "node", "left").select("node", F.col("root").alias("was"), F.least("root", F.coalesce("near", "root")).alias("root"))
        jump = now.select(F.col("node").alias("root"), F.col("root").alias("far"))
        new = settled(step.join(jump, "root").select("node", "was", F.least("root", "far").alias("root")))
        if new.filter("root <> was").isEmpty():
            return new.select("node", "root")
        now = new.select("node", "root")


def followed(links: DataFrame) -> DataFrame:
    """(node, root): the last node that links(node, next), one for each node and without circles, lead to. Each round follows
    the roots found so far, which doubles the steps taken."""
    now = settled(links.select("node", F.col("next").alias("root"), F.lit(True).alias("moved")))
    while not now.filter("moved").isEmpty():
        ahead = now.select(F.col("node").alias("root"), F.col("root").alias("far"))
        now = settled(now.join(ahead, "root", "left").select("node", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
    return now.select("node", "root")


def grown(seqs: DataFrame, links: DataFrame) -> DataFrame:
    """(seq, seed) of seqs(seq, size) and links(u, v): the first sequence, by falling size, then by sequence, from which links
    lead to it without ever rising in size. In that order, each sequence that none before it reaches is a seed.

    A round takes the least seed of the neighbours that are no smaller, and that seed's own seed; rounds number about the
    logarithm of the longest path.
    """
    both = links.select("u", "v").union(links.select("v", "u"))
    of = lambda side: seqs.select(F.col("seq").alias(side), F.col("size").alias(f"{side}_size"))
    down = settled(both.join(of("u"), "u").join(of("v"), "v").filter("u_size >= v_size").select("u", "v").distinct())
    now = settled(seqs.select("seq", F.struct((-F.col("size")).alias("s"), F.col("seq").alias("n")).alias("seed")))
    while True:
        near = down.join(now.select(F.col("seq").alias("u"), "seed"), "u").groupBy(F.col("v").alias("seq")).agg(F.min("seed").alias("near"))
        step = now.join(near, "seq", "left").select("seq", F.col("seed").alias("was"), F.least("seed", F.coalesce("near", "seed")).alias("seed"))
        jump = now.select(F.col("seq").alias("n"), F.col("seed").alias("far"))
        new = settled(step.join(jump, step["seed.n"] == jump["n"]).select("seq", "was", F.least("seed", "far").alias("seed")))
        if new.filter("seed <> was").isEmpty():
            return new.select("seq", F.col("seed.n").alias("seed"))
        now = new.select("seq", "seed")
