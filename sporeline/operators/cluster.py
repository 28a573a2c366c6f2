"""Order-dependent sequence algorithms, as rounds of joins.

A greedy choice depends on a sequence's more abundant neighbours alone. So all sequences whose more abundant neighbours
are settled are settled at once, and rounds are as many as the longest chain of ever less abundant neighbours.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.functions import seq as S
from sporeline.operators import graph


def _clustered(seqs: DataFrame, links: DataFrame, accept, directed: bool = False) -> DataFrame:
    """(seq, centroid) of seqs(seq, size) and links(u, v, how): in order of size, then sequence, a sequence joins the
    settled centroid with the largest ``how`` (then size) among its neighbours that ``accept`` allows, or becomes one.
    Directed links say that u may join v, not the reverse."""
    seqs = graph.settled(seqs)
    both = links.select("u", "v", "how")
    if not directed:
        both = both.union(links.select("v", "u", "how"))
    of = lambda side: seqs.select(F.col("seq").alias(side), F.col("size").alias(f"{side}_size"))
    up = both.join(of("u"), "u").join(of("v"), "v")
    before = (F.col("v_size") > F.col("u_size")) | ((F.col("v_size") == F.col("u_size")) & (F.col("v") < F.col("u")))
    up = graph.settled(up.filter(before & accept(F.col("u_size"), F.col("v_size"), F.col("how"))).select("u", "v", "v_size", "how"))
    new = graph.settled(seqs.join(up.select(F.col("u").alias("seq")), "seq", "left_anti").select("seq", F.col("seq").alias("centroid")))
    done, left = [new], up.withColumn("centroid", F.lit(None).cast("string"))
    while True:
        # What is settled now is noted at the links that wait for it; settled sequences' links go, so a round reads what is left.
        told = left.join(new.select(F.col("seq").alias("v"), F.col("centroid").alias("c")), "v", "left")
        left = graph.settled(told.select("u", "v", "v_size", "how", F.coalesce("centroid", "c").alias("centroid")))
        best = F.min(F.when(F.col("centroid") == F.col("v"), F.struct((-F.col("how")).alias("h"), (-F.col("v_size")).alias("s"), "v")))
        ready = left.groupBy("u").agg(F.bool_or(F.col("centroid").isNull()).alias("waits"), best.alias("b")).filter("not waits")
        new = graph.settled(ready.select(F.col("u").alias("seq"), F.coalesce("b.v", "u").alias("centroid")))
        if new.isEmpty():
            return functools.reduce(DataFrame.union, done)
        done.append(new)
        left = left.join(new.select(F.col("seq").alias("u")), "u", "left_anti")


def greedy(seqs: DataFrame, identity: float, definition: int | None = None, coverage: float = 0.9, both_strands: bool = False) -> DataFrame:
    """(seq, centroid) of seqs(seq, size), distinct: in order of size, a sequence joins the nearest centroid that is at
    least ``identity`` alike, or becomes one. Identity is that of edits, or by alignment with definition 1 or 2, as in
    ``graph.matches``, there on both strands if asked for."""
    links = graph.similar(seqs, identity) if definition is None else graph.matches(seqs, identity, definition, coverage, both_strands)
    return _clustered(seqs, links.select("u", "v", F.col("identity").alias("how")), lambda q, c, h: F.lit(True))


def greedy_by_sample(rows: DataFrame, identity: float, definition: int = 2, coverage: float = 0.9, both_strands: bool = False) -> DataFrame:
    """(SampleID, seq, centroid) of rows(SampleID, seq, size), distinct: ``greedy`` within each sample. Sequences are compared
    once, whatever samples they are in."""
    key = lambda seq: F.concat_ws("\t", F.base64(F.coalesce("SampleID", F.lit("")).cast("binary")), seq)
    rows = graph.settled(rows.select("SampleID", "seq", "size", key(F.col("seq")).alias("key")))
    links = graph.settled(graph.matches(rows.select("seq").distinct(), identity, definition, coverage, both_strands))
    of = lambda side: rows.select(F.col("SampleID").alias("s"), F.col("seq").alias(side), F.col("key").alias(f"{side}_key"))
    within = links.join(of("u"), "u").join(of("v").withColumnRenamed("s", "t"), "v").filter(F.col("s").eqNullSafe(F.col("t")))
    found = _clustered(rows.select(F.col("key").alias("seq"), "size"), within.select(F.col("u_key").alias("u"), F.col("v_key").alias("v"), F.col("identity").alias("how")), lambda q, c, h: F.lit(True))
    return found.select(F.col("seq").alias("key"), F.element_at(F.split("centroid", "\t"), 2).alias("centroid")).join(rows, "key").select("SampleID", "seq", "centroid")


def unoise(seqs: DataFrame, alpha: float = 6.0) -> DataFrame:
    """(seq, centroid): a sequence is an error of a centroid d edits away if its size is at most 2 ** -(alpha * d + 1) of it.
    No centroid is so large that more than (log2(largest / smallest) - 1) / alpha edits count, so links go no further."""
    low, high = seqs.agg(F.min("size"), F.max("size")).first()
    most = max(0, int((math.log2(high / low) - 1) / alpha + 1e-9)) if low and high else 0
    links = graph.edit_links(seqs.select("seq"), most).select("u", "v", (-F.col("distance")).cast("double").alias("how"))
    return _clustered(seqs, links, lambda q, c, h: q / c <= F.pow(F.lit(2.0), -(-h * alpha + 1)))


def swarm(seqs: DataFrame, d: int = 1, fastidious: bool = False, boundary: int = 3, breaking: bool = False) -> DataFrame:
    """(seq, centroid): components of links of at most d edits among pure ACGT sequences; the most abundant member
    represents. With breaking, swarms grow from their most abundant member by links that don't rise in size, and the more
    abundant take first, so a chain is cut at its valleys. Fastidious (d = 1): a swarm of less than ``boundary`` reads joins
    the heaviest larger swarm (then the least centroid) of which a member is two edits from one of its own."""
    pure = graph.settled(seqs.filter(F.col("seq").rlike("^[ACGT]*$")))
    near = graph.edit_links(pure.select("seq"), d)
    if breaking:
        roots = graph.grown(pure, near).withColumnRenamed("seed", "root")
    else:
        roots = graph.components(pure.select(F.col("seq").alias("node")), near).withColumnRenamed("node", "seq")
    own = pure.join(roots, "seq")
    best = own.groupBy("root").agg(F.min(F.struct((-F.col("size")).alias("s"), "seq"))["seq"].alias("centroid"), F.sum("size").alias("mass"))
    out = graph.settled(own.join(best, "root").select("seq", "centroid", "mass"))
    if not fastidious:
        return out.select("seq", "centroid")
    far = graph.edit_links(pure.select("seq"), d + 1).select("u", "v")
    ends = lambda side: out.select(F.col("seq").alias(side), F.col("centroid").alias(f"{side}_c"), F.col("mass").alias(f"{side}_m"))
    grafts = far.union(far.select("v", "u")).join(ends("u").filter(F.col("u_m") < boundary), "u").join(ends("v").filter(F.col("v_m") >= boundary), "v")
    onto = grafts.groupBy(F.col("u_c").alias("centroid")).agg(F.min(F.struct((-F.col("v_m")).alias("m"), "v_c"))["v_c"].alias("onto"))
    return out.join(onto, "centroid", "left").select("seq", F.coalesce("onto", "centroid").alias("centroid"))


def overlap_links(seqs: DataFrame, coverage: float = 0.96, k: int = 16) -> DataFrame:
    """(u, v): u and v, of distinct seqs(seq), agree in every base of an overlap without gaps that covers at least
    ``coverage`` (over a half) of u; what overhangs at the ends doesn't count.

    Every such overlap holds u's core, the bases that all long enough stretches of u have in common. So u meets others on
    the k-mer of its core that is rarest in the corpus, and only there; each meeting fixes the overlap, which is compared
    whole. k is lowered to the shortest core.
    """
    need = F.ceil(F.length("seq") * F.lit(coverage) - 1e-9).cast("int")
    rows = graph.settled(seqs.filter(F.length("seq") > 0).select("seq", need.alias("need"), F.length("seq").alias("n")).withColumn("id", F.monotonically_increasing_id()))
    shortest = rows.agg(F.min(2 * F.col("need") - F.col("n"))).first()[0]
    k = max(1, min(k, shortest or k))
    # Numbers stand for the sequences until they meet.
    placed = graph.settled(rows.select("id", "n", "need", F.posexplode(S.kmers(F.col("seq"), k)).alias("at", "kmer")))
    often = placed.groupBy("kmer").agg(F.count("*").alias("often"))
    inner = placed.filter((F.col("at") >= F.col("n") - F.col("need")) & (F.col("at") + k <= F.col("need")))
    rare = F.min(F.struct("often", "at", "kmer")).alias("r")
    asked = inner.join(often, "kmer").groupBy("id", "need").agg(rare).select(F.col("id").alias("u_id"), "need", F.col("r.at").alias("a"), "r.kmer")
    met = asked.join(placed.select(F.col("id").alias("v_id"), F.col("at").alias("b"), "kmer"), "kmer").filter("u_id <> v_id")
    of = lambda side: rows.select(F.col("id").alias(f"{side}_id"), F.col("seq").alias(side))
    met = met.join(of("u"), "u_id").join(of("v"), "v_id")
    # Positions in u at which v begins and ends, cut to u.
    spans = met.withColumn("start", F.expr("greatest(0, a - b)")).withColumn("end", F.expr("least(length(u), a - b + length(v))"))
    same = F.expr("substring(u, start + 1, end - start) = substring(v, start + b - a + 1, end - start)")
    return spans.filter((F.col("end") - F.col("start") >= F.col("need")) & same).select("u", "v").distinct()


def contained(seqs: DataFrame, coverage: float = 0.96, both_strands: bool = False) -> DataFrame:
    """K8: (seq, centroid) of distinct seqs(seq, size): in order of size, a sequence joins the most abundant centroid with
    which it agrees over ``coverage`` of itself, on either strand if asked for, or becomes one."""
    if both_strands:
        met = graph.settled(graph.matches(seqs.select("seq"), 1.0, 2, coverage, True))
        links = met.select("u", "v").union(met.filter(F.col("v_coverage") >= coverage - 1e-12).select("v", "u"))
    else:
        links = overlap_links(seqs.select("seq"), coverage)
    return _clustered(seqs, links.withColumn("how", F.lit(1.0)), lambda q, c, h: F.lit(True), directed=True)


def linclust(seqs: DataFrame, k: int, m: int, identity: float, coverage: float = 0.0, definition: int | None = None) -> DataFrame:
    """(seq, centroid) in linear time: each sequence is filed under its m least k-mer hashes; each file's longest member
    (then first) is the centre that the others are compared with, and components of what holds are clusters.

    What holds: an edit identity, or by definition 1 or 2 that of an alignment in which ``coverage`` of either is aligned;
    the k-mer in common gives the diagonal, and the band has room for the edits of the identity.
    """
    from sporeline.operators import align

    kmer = lambda x, i: F.struct(F.xxhash64(x).alias("key"), i.alias("at"))
    hashes = F.slice(F.array_sort(F.transform(S.kmers(F.col("seq"), k), kmer)), 1, m)
    keyed = seqs.select("seq", F.explode(hashes).alias("h")).groupBy("seq", F.col("h.key").alias("key")).agg(F.min("h.at").alias("at"))
    longest = F.min(F.struct((-F.length("seq")).alias("l"), "seq", "at"))
    centre = keyed.groupBy("key").agg(longest.alias("c")).select("key", F.col("c.seq").alias("v"), F.col("c.at").alias("v_at"))
    met = keyed.join(centre, "key").filter("seq <> v").select(F.col("seq").alias("u"), "v", (F.col("v_at") - F.col("at")).alias("d"))
    if definition is None:
        links = met.select("u", "v").distinct().filter(graph.identity(F.col("u"), F.col("v")) >= identity)
    else:
        met = met.groupBy("u", "v").agg(F.min("d").alias("low"), F.max("d").alias("high"))
        room = F.floor(F.length("u") * ((1 - identity) / identity) + 1e-9).cast("int")
        done = align.aligned(met.select("u", "v", (F.col("low") - room).alias("low"), (F.col("high") + room).alias("high")))
        covered = F.col("aligned") / F.greatest(F.length("u"), F.length("v")) >= coverage - 1e-12
        links = done.filter((align.identity(definition) >= identity - 1e-12) & covered).select("u", "v")
    return graph.components(seqs.select(F.col("seq").alias("node")), links).select(F.col("node").alias("seq"), F.col("root").alias("centroid"))


def pair_stats(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """Co-occurrence of pairs(query, parent) over cells(OTU, SampleID, Abundance), an OTU once in a sample: totals, overlap
    and ratios.

    Only samples in common are rows of a join: both ways of a pair are told from them at once, and they are sought from the
    cells of the OTU that has fewer. How many samples a query has is known from its total.
    """
    total = cells.groupBy("OTU").agg(F.sum("Abundance").alias("total"), F.count("*").alias("spread"))
    t = lambda side: total.select(F.col("OTU").alias(side), F.col("total").alias(f"{side}_total"), F.col("spread").alias(f"{side}_n"))
    asked = pairs.groupBy("query", "parent").agg(F.count("*").alias("times")).join(t("query"), "query").join(t("parent"), "parent")
    fewer = (F.col("query_n") < F.col("parent_n")) | ((F.col("query_n") == F.col("parent_n")) & (F.col("query") <= F.col("parent")))
    asked = asked.withColumns({"few": F.when(fewer, F.col("query")).otherwise(F.col("parent")), "many": F.when(fewer, F.col("parent")).otherwise(F.col("query"))})
    asked = graph.settled(asked)
    of = lambda side, n: cells.select(F.col("OTU").alias(side), "SampleID", F.col("Abundance").alias(n))
    met = asked.select("few", "many").distinct().join(of("few", "x"), "few").join(of("many", "y"), ["many", "SampleID"])
    ratio = lambda p, q: [f(F.try_divide(F.col(p), F.col(q))).alias(f"{k}_{p}") for k, f in (("min", F.min), ("max", F.max), ("sum", F.sum))]
    both = met.groupBy("few", "many").agg(*[F.count(n).alias(f"n_{n}") for n in "xy"], *ratio("x", "y"), *ratio("y", "x"))
    out = asked.join(both, ["few", "many"], "left")
    # The parent's share of the ratios: the larger OTU's where the query is the smaller one.
    side = lambda k: F.when(F.col("query") == F.col("few"), F.col(f"{k}_y")).otherwise(F.col(f"{k}_x"))
    overlap = F.coalesce(side("n"), F.lit(0))
    return out.select(
        "parent", "query", (F.col("query_n") * F.col("times")).alias("query_spread"), (overlap * F.col("times")).alias("overlap"),
        side("min").alias("min_ratio"), side("max").alias("max_ratio"), F.try_divide(side("sum"), overlap).alias("avg_ratio"),
        "query_total", "parent_total", (overlap / F.col("query_n")).alias("cooccurrence"),
    )


def curate(cells: DataFrame, pairs: DataFrame, cooccurrence: float = 0.95, ratio: float = 1.0, ratio_type: str = "min", max_hits: int | None = None) -> DataFrame:
    """(OTU, parent) of cells(OTU, SampleID, Abundance) and pairs(query, parent, identity): in the order of samples, then total
    (both falling), then OTU, an OTU is merged into the most similar (then first) OTU before it that is where it is in at
    least ``cooccurrence`` of its samples, and more abundant there by over ``ratio``, at least ('min') or on average ('avg').
    What its parent is merged into takes it on.

    A choice depends on the two OTUs' own samples alone, so all are made at once, and chains of parents are followed then.
    ``max_hits`` takes no more than so many of a query's most similar.
    """
    if ratio_type not in ("min", "avg"):
        raise ValueError(f"ratio type: {ratio_type}")
    total = cells.groupBy("OTU").agg(F.sum("Abundance").alias("total"), F.count("*").alias("spread"))
    rank = F.struct((-F.col("spread")).alias("s"), (-F.col("total")).alias("t"), "OTU")
    of = lambda side: total.select(F.col("OTU").alias(side), rank.alias(f"{side}_rank"))
    ranked = pairs.join(of("query"), "query").join(of("parent"), "parent")
    if max_hits is not None:
        best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("identity")).alias("i"), "parent_rank", "query_rank", "parent"))), 1, max_hits)
        ranked = ranked.groupBy("query").agg(best.alias("b")).select("query", F.explode("b").alias("b"))
        ranked = ranked.select("query", "b.parent", (-F.col("b.i")).alias("identity"), "b.parent_rank", "b.query_rank")
    before = graph.settled(ranked.filter("parent_rank < query_rank").select("query", "parent", "identity", "parent_rank"))
    s = pair_stats(cells, before.select("query", "parent")).join(before, ["query", "parent"])
    good = s.filter((F.col("cooccurrence") >= cooccurrence) & (F.col(f"{ratio_type}_ratio") > ratio))
    chosen = good.groupBy("query").agg(F.min(F.struct((-F.col("identity")).alias("i"), "parent_rank", "parent"))["parent"].alias("next"))
    roots = graph.followed(chosen.select(F.col("query").alias("node"), "next"))
    return total.select("OTU").join(roots.withColumnRenamed("node", "OTU"), "OTU", "left").select("OTU", F.coalesce("root", "OTU").alias("parent"))


def merge_curated(cells: DataFrame, parents: DataFrame) -> DataFrame:
    return cells.join(parents, "OTU").groupBy(F.col("parent").alias("OTU"), "SampleID").agg(F.sum("Abundance").alias("Abundance"))


def merge_pairs(pairs: DataFrame, least: int = 20, most_diff: int = 5, percent: float = 20.0) -> DataFrame:
    """(id, seq) of pairs(id, r1, r2): R1 and the reverse complement of R2 overlap by the longest stretch of at least
    ``least`` bases within the bounds of differences; pairs without one are dropped."""
    rows = pairs.select("id", "r1", S.revcomp(F.col("r2")).alias("r2"))
    longest = F.least(F.length("r1"), F.length("r2"))
    overlaps = F.when(longest >= least, F.sequence(longest, F.lit(least))).otherwise(F.array().cast("array<int>"))

    def fits(n):
        d = S.hamming(F.substring(F.col("r1"), F.length("r1") - n + 1, n), F.substring(F.col("r2"), F.lit(1), n))
        return (d <= most_diff) & (d * 100.0 <= percent * n)

    found = rows.withColumn("_o", F.filter(overlaps, fits))
    found = found.filter(F.size("_o") > 0).withColumn("n", F.element_at("_o", 1))
    return found.select("id", F.concat("r1", F.substring(F.col("r2"), F.col("n") + 1, F.length("r2"))).alias("seq"))


def merge_pairs_by_quality(pairs: DataFrame, least: int = 20, most_diff: int = 5, percent: float = 20.0, cap: int = 41) -> DataFrame:
    """K4: (id, seq, qual, overlap, differences, merged) of pairs(id, r1, q1, r2, q2), overlapping as in ``merge_pairs``.

    In the overlap the better base stands (R1's if equal), with the quality of its posterior error: for bases with errors p
    and q that agree pq/3 / (1 - p - q + 4pq/3), and for p's base against q's p(1 - q/3) / (p + q - 4pq/3), up to ``cap``. A
    pair that doesn't overlap comes back with merged false and without a sequence.
    """
    rows = pairs.select("id", "r1", "q1", S.revcomp(F.col("r2")).alias("r2"), F.reverse("q2").alias("q2"))
    longest = F.least(F.length("r1"), F.length("r2"))
    overlaps = F.when(longest >= least, F.sequence(longest, F.lit(least))).otherwise(F.array().cast("array<int>"))

    def fits(n):
        d = S.hamming(F.substring(F.col("r1"), F.length("r1") - n + 1, n), F.substring(F.col("r2"), F.lit(1), n))
        return (d <= most_diff) & (d * 100.0 <= percent * n)

    rows = rows.withColumn("n", F.get(F.filter(overlaps, fits), F.lit(0)))
    start = F.length("r1") - F.col("n")
    letter = lambda c, i: F.substring(F.col(c), i.cast("int"), F.lit(1))
    error = lambda c, i: F.pow(F.lit(10.0), (F.lit(33) - F.ascii(letter(c, i))) / 10.0)

    def settled_base(i):
        a, b, p, q = letter("r1", start + i), letter("r2", i), error("q1", start + i), error("q2", i)
        agree = p * q / 3 / (1 - p - q + 4 * p * q / 3)
        low, high = F.least(p, q), F.greatest(p, q)
        left = F.when(a == b, agree).otherwise(low * (1 - high / 3) / (p + q - 4 * p * q / 3))
        phred = F.least(F.lit(float(cap)), F.round(-10 * F.log10(F.greatest(left, F.lit(1e-30)))))
        return F.struct(F.when((a == b) | (p <= q), a).otherwise(b).alias("base"), F.char(phred.cast("int") + 33).alias("phred"), (a != b).cast("int").alias("differs"))

    both = F.when(F.col("n").isNotNull(), F.transform(F.sequence(F.lit(1), F.col("n")), settled_base))
    rows = rows.withColumn("both", both)
    joined = lambda head, field, tail: F.concat(F.substring(F.col(head), F.lit(1), start), F.array_join(f"both.{field}", ""), F.substring(F.col(tail), F.col("n") + 1, F.length(tail)))
    return rows.select(
        "id", joined("r1", "base", "r2").alias("seq"), joined("q1", "phred", "q2").alias("qual"), F.col("n").alias("overlap"),
        F.aggregate("both.differs", F.lit(0), lambda x, y: x + y).alias("differences"), F.col("n").isNotNull().alias("merged"),
    )
