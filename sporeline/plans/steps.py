"""The three workflows as compositions of operators: Step 1 (reads to a sequence table), Step 2 (tables to OTUs), seqstats.

One DataFrame with a sample column stands where a workflow would run a task for each sample, so there are no barriers but
the aggregates themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.functions import seq as S
from sporeline.operators import chimera, cluster, denoise, derep, graph, membership, models, otu, summary, tagjump, tags


@dataclass(frozen=True)
class Params:
    """Parameters that change results, with their defaults."""

    max_ee: float | None = None
    max_ee_rate: float | None = 0.01
    max_n: int = 4
    max_run: int = 25
    primer_forward: str | None = None
    primer_reverse: str | None = None
    primer_mismatches: int = 2
    trim_least: int = 10
    homopolymers: bool = True
    rescue_over: int = 2
    tj: bool = True
    tj_f: float = 0.01
    tj_p: float = 1.0
    tj_identity: float = 0.99
    tj_iddef: int = 2
    hp_identity: float = 0.999
    hp_iddef: int = 2
    max_meep: float = 0.5
    max_chimera: float = 0.6
    recover_singletons: bool = True
    recover_chimeras: bool = True
    merge_replicates: bool = False
    least_length: int | None = None
    most_length: int | None = None
    preclustering: str = "none"
    clustering: str = "greedy"
    otu_identity: float = 0.98
    unoise_alpha: float = 6.0
    dada_omega_a: float = 1e-20
    dada_omega_c: float = 1e-40
    otu_iddef: int = 2
    lulu: bool = False
    lulu_match: float = 0.95
    lulu_cooccurrence: float = 0.95
    lulu_ratio: float = 1.0
    lulu_ratio_type: str = "min"
    lulu_max_hits: int | None = None

    def __post_init__(self):
        if self.lulu and self.clustering == "none":
            raise ValueError("curation needs clustering")
        if self.preclustering not in ("none", "unoise", "swarm", "homopolymer", "dada"):
            raise ValueError(f"preclustering: {self.preclustering}")
        if self.clustering not in ("none", "greedy", "swarm"):
            raise ValueError(f"clustering: {self.clustering}")


def step1(reads: DataFrame, p: Params = Params()) -> DataFrame:
    """The long sequence table of reads(SampleID, id, seq, qual)."""
    good = derep.quality_filter(reads, p.max_ee, p.max_ee_rate, p.max_n, p.max_run).select("SampleID", "id", "seq", "qual")
    if p.primer_forward and p.primer_reverse:
        good = tags.trim(good, p.primer_forward, p.primer_reverse, p.primer_mismatches, p.trim_least)
    good = good.filter(F.length("seq") >= p.trim_least)
    ee = S.expected_errors(F.col("qual"))  # of what is left of the read
    hashed = good.select("SampleID", S.seq_id(F.col("seq")).alias("SeqID"), "seq", S.mean_phred(F.col("qual")).alias("PhredScore"), ee.alias("MaxEE"), S.meep(ee, F.length("qual")).alias("MEEP"))
    per_sample = hashed.groupBy("SampleID", "SeqID", "seq").agg(F.count("*").alias("size"))
    if p.homopolymers:
        # Per sample, sequences whose collapsed forms are nearly equal, on either strand, take the id of the most abundant.
        collapsed = graph.settled(per_sample.withColumn("k", S.homopolymer_collapse(F.col("seq"))))
        forms = collapsed.groupBy("SampleID", F.col("k").alias("seq")).agg(F.sum("size").alias("size"))
        groups = cluster.greedy_by_sample(forms, p.hp_identity, p.hp_iddef, both_strands=True)
        named = groups.select(F.col("SampleID").alias("s"), F.col("seq").alias("g"), "centroid")
        collapsed = collapsed.join(named, (F.col("SampleID").eqNullSafe(F.col("s"))) & (F.col("k") == F.col("g")))
        # The original that a centroid stands for is its own form's.
        best = F.min(F.struct((F.col("k") != F.col("centroid")).alias("other"), (-F.col("size")).alias("s"), "SeqID", "seq"))
        per_sample = collapsed.groupBy("SampleID", "centroid").agg(F.sum("size").alias("size"), best.alias("b")).select("SampleID", "b.SeqID", "b.seq", "size")
    per_sample = graph.settled(per_sample)
    found = graph.settled(models.denovo_chimeras(per_sample.select("SampleID", "seq", "size")).filter("chimera"))
    # Sequences that are taken for chimeras in many samples are no chimeras.
    found = found.join(chimera.rescue(found, p.rescue_over, "seq").select("seq").distinct(), "seq", "left_anti")
    scores = found.select("SampleID", S.seq_id(F.col("seq")).alias("SeqID"), F.col("score").alias("DeNovo_Chimera_Score"))
    cells = per_sample.select("SeqID", "SampleID", F.col("size").alias("Abundance"))
    if p.tj:
        # Tag jumps are judged by clusters of nearly equal sequences.
        sized = per_sample.groupBy("seq").agg(F.sum("size").alias("size"))
        clust = cluster.greedy(sized, p.tj_identity, p.tj_iddef).select(S.seq_id(F.col("seq")).alias("SeqID"), S.seq_id(F.col("centroid")).alias("OTU"))
        rows = graph.settled(cells.join(clust, "SeqID"))
        marked = tagjump.flag(rows, tagjump.scores(rows.select("OTU", "SampleID", "Abundance"), p.tj_f, p.tj_p))
        cells = marked.filter(~F.col("TagJump")).select("SeqID", "SampleID", "Abundance")
    sequences = per_sample.groupBy("SeqID").agg(F.min("seq").alias("Sequence"))
    return otu.assemble(cells, hashed.drop("seq"), scores, sequences)


def step2(runs: list[DataFrame], p: Params = Params()) -> dict[str, DataFrame]:
    """membership, long, wide order and sequences of the union of sequence tables."""
    rows = chimera.remove(otu.union_runs(runs), p.max_chimera, p.recover_chimeras).filter(F.col("Sequence").isNotNull())
    if p.least_length or p.most_length:
        rows = derep.length_band(rows.withColumn("seq", F.col("Sequence")), p.least_length, p.most_length).drop("seq")
    # Strands are one sequence, in its more abundant orientation.
    rows = graph.settled(rows.withColumn("_lesser", S.canonical(F.col("Sequence"))))
    turned = rows.groupBy("_lesser", "Sequence").agg(F.sum("Abundance").alias("a"))
    turned = turned.groupBy("_lesser").agg(F.min(F.struct((-F.col("a")).alias("a"), "Sequence"))["Sequence"].alias("_canon"))
    rows = graph.settled(rows.join(turned, "_lesser").drop("_lesser"))
    unique = rows.groupBy(F.col("_canon").alias("seq")).agg(F.sum("Abundance").alias("size"))
    # A cluster is named by the most abundant SeqID of its centroid.
    name = F.min(F.struct((-F.col("Abundance")).alias("a"), "SeqID"))["SeqID"].alias("name")
    by_id = rows.groupBy("_canon", "SeqID").agg(F.sum("Abundance").alias("Abundance"))
    names = graph.settled(by_id.groupBy(F.col("_canon").alias("seq")).agg(name))
    derep_map = rows.select(F.col("SeqID").alias("query"), F.col("_canon").alias("seq")).distinct().join(names, "seq").select("query", F.col("name").alias("target"))
    pre = None
    if p.preclustering == "unoise":
        pre = cluster.unoise(unique, p.unoise_alpha)
    elif p.preclustering == "swarm":
        pre = cluster.swarm(unique, breaking=True)
    elif p.preclustering == "dada":
        learnt, near = denoise.learn(unique.withColumn("bucket", F.lit("")), p.dada_omega_a)
        pre = denoise.infer(unique.withColumn("bucket", F.lit("")), learnt, p.dada_omega_a, p.dada_omega_c, near=near)
        pre = graph.settled(pre.filter("centre is not null").select("seq", F.col("centre").alias("centroid")))
    elif p.preclustering == "homopolymer":
        key = S.homopolymer_collapse(F.col("seq"))
        best = unique.groupBy(key.alias("k")).agg(F.min(F.struct((-F.col("size")).alias("s"), "seq"))["seq"].alias("centroid"))
        pre = unique.withColumn("k", key).join(best, "k").select("seq", "centroid")
    sized = unique
    if pre is not None:
        sized = unique.join(pre, "seq").groupBy(F.col("centroid").alias("seq")).agg(F.sum("size").alias("size"))
    if p.clustering == "greedy":
        clust = cluster.greedy(sized, p.otu_identity, p.otu_iddef, both_strands=True)
    elif p.clustering == "swarm":
        clust = cluster.swarm(sized, breaking=True)
    else:
        clust = sized.select("seq", F.col("seq").alias("centroid"))

    def as_map(m: DataFrame) -> DataFrame:
        ends = names.select(F.col("seq").alias("centroid"), F.col("name").alias("target"))
        return m.join(names.withColumnRenamed("name", "query"), "seq").join(ends, "centroid").select("query", "target")

    members = membership.compose(derep_map, as_map(clust), None if pre is None else as_map(pre))
    members = graph.settled(members)
    joined = otu.mapped(rows.drop("_canon"), members)
    joined = otu.drop_singletons(joined, p.max_meep if p.recover_singletons else None)
    long = otu.long_table(joined, p.merge_replicates)
    if p.lulu:
        both = clust.select(F.col("centroid").alias("seq")).distinct()
        links = graph.settled(graph.matches(both, p.lulu_match, 1))
        # A query is aligned over nine tenths of itself.
        ends = lambda q, t: links.filter(F.col(f"{q}_coverage") >= 0.9).select(F.col(q).alias("q"), F.col(t).alias("t"), "identity")
        named = lambda side, as_: names.select(F.col("seq").alias(side), F.col("name").alias(as_))
        pairs = graph.settled(ends("u", "v").union(ends("v", "u")).join(named("q", "query"), "q").join(named("t", "parent"), "t").select("query", "parent", "identity"))
        long = cluster.merge_curated(long, cluster.curate(long, pairs, p.lulu_cooccurrence, p.lulu_ratio, p.lulu_ratio_type, p.lulu_max_hits))
    return {"membership": members, "long": long, "order": otu.ranked(long), "sequences": clust}


def seqstats(raw: DataFrame, qc: DataFrame, artefacts: DataFrame) -> DataFrame:
    """Per sample: reads before and after quality control, artefacts, and their shares in basis points."""
    count = lambda x: x.groupBy(F.col("SampleID").alias("file")).agg(F.count("*").alias("n"))
    out = summary.fold({"raw": count(raw), "qc": count(qc), "artefacts": count(artefacts)})
    return out.withColumn("qc_bp", summary.basis_points(F.col("qc"), F.col("raw"))).withColumn("artefact_bp", summary.basis_points(F.col("artefacts"), F.col("qc"), 0))
