"""Dereplication, homopolymer correction, sequence filters and read statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sporeline.functions import seq as S


def dereplicate(reads: DataFrame, key: Column | None = None, size: str = "size") -> DataFrame:
    """(seq_key, size, n_members, first_id) of reads(id, seq, size); the first id is the least of the largest size."""
    k = F.col("seq") if key is None else key
    rows = reads.select(k.alias("seq_key"), "id", F.col(size).alias("size"))
    return rows.groupBy("seq_key").agg(
        F.sum("size").alias("size"), F.count("*").alias("n_members"), F.min(F.struct((-F.col("size")).alias("s"), "id"))["id"].alias("first_id")
    )


def both_strands(reads: DataFrame) -> DataFrame:
    return dereplicate(reads, S.canonical(F.col("seq")))


def correct_homopolymers(reads: DataFrame) -> DataFrame:
    """(id, seq, size): reads merge by their collapsed sequence; the representative, the least id of the largest size (then
    the first sequence), keeps its own sequence. Ids may repeat."""
    best = F.min(F.struct((-F.col("size")).alias("s"), "id", "seq"))
    merged = reads.groupBy(S.homopolymer_collapse(F.col("seq")).alias("k")).agg(F.sum("size").alias("size"), best.alias("b"))
    return merged.select("b.id", "b.seq", "size")


def quality_filter(reads: DataFrame, max_ee: float | None = None, max_rate: float | None = 0.01, max_n: int = 4, max_run: int = 25) -> DataFrame:
    """Reads within the limits of expected errors, their rate, ambiguous bases and homopolymer runs."""
    out = reads
    ee = S.expected_errors(F.col("qual"))
    if max_ee is not None:
        out = out.filter(ee <= max_ee)
    if max_rate is not None:
        out = out.filter(F.try_divide(ee, F.length("qual")) <= max_rate)
    return out.filter(S.n_count(F.col("seq")) <= max_n).filter(~S.has_homopolymer(F.col("seq"), max_run))


def length_band(reads: DataFrame, least: int | None, most: int | None) -> DataFrame:
    out = reads
    if least is not None:
        out = out.filter(F.length("seq") >= least)
    return out if most is None else out.filter(F.length("seq") <= most)


def mean_quality(reads: DataFrame) -> DataFrame:
    """(seq, pos, mean_q): per position, the mean score weighted by size, over reads of one sequence."""
    q = reads.select("seq", "size", F.posexplode(S.phred(F.col("qual"))).alias("pos", "q"))
    return q.groupBy("seq", "pos").agg((F.sum(F.col("q") * F.col("size")) / F.sum("size")).alias("mean_q"))


def per_file(reads: DataFrame, by: str = "SampleID") -> DataFrame:
    return reads.groupBy(by).agg(F.count("*").alias("num_seqs"), F.sum(F.length("seq")).alias("sum_len"))


def singleton_stats(derep: DataFrame) -> DataFrame:
    return derep.agg(F.count("*").alias("n_seqs"), F.count_if(F.col("size") < 2).alias("n_singletons"), F.sum("size").alias("n_reads"))


def total_size(headers: DataFrame) -> DataFrame:
    """One row: the sum of the size annotations of headers(header)."""
    return headers.agg(F.coalesce(F.sum(F.regexp_extract("header", ";size=([0-9]+)", 1).try_cast("long")), F.lit(0)).alias("reads"))


def trim_poly_g(seq: Column, least: int = 10, each: int = 8, most: int = 5) -> Column:
    """How many bases to cut from a read's end: a stretch of G of at least ``least`` bases, in which one other base for
    every ``each`` is allowed, ``most`` in all, back to its first G; 0 without such a stretch."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("miss"), F.lit(0).alias("cut"), F.lit(True).alias("on"))

    def step(s, base):
        n, miss = s["n"] + 1, s["miss"] + (base != "G").cast("int")
        ends = (miss > most) | ((miss > F.floor(n / each)) & (n >= least))
        more = F.struct(n.alias("n"), miss.alias("miss"), F.when(base == "G", n).otherwise(s["cut"]).alias("cut"), F.lit(True).alias("on"))
        stop = F.struct(s["n"].alias("n"), s["miss"].alias("miss"), s["cut"].alias("cut"), F.lit(False).alias("on"))
        return F.when(~s["on"] | ends, stop).otherwise(more)

    return F.aggregate(F.split(F.reverse(seq), ""), start, step, lambda s: F.when(s["n"] >= least, s["cut"]).otherwise(0))


def paired_qc(
    pairs: DataFrame, mean_quality: float = 0, qualified: int = 15, unqualified_percent: float = 40, max_n: int = 5, poly_g: int | None = None, least: int = 100
) -> DataFrame:
    """pairs(id, r1, q1, r2, q2), of which both reads pass after their ends of G are cut (``poly_g``: shortest stretch).

    A read passes with at most ``unqualified_percent`` of its bases under ``qualified``, a mean quality of at least
    ``mean_quality``, at most ``max_n`` N and at least ``least`` bases. One projection and a filter; no shuffle.
    """
    rows = pairs
    if poly_g:
        rows = rows.withColumn("_cut", F.struct(trim_poly_g(F.col("r1"), poly_g).alias("r1"), trim_poly_g(F.col("r2"), poly_g).alias("r2")))
        short = lambda c, r: F.substring(F.col(c), F.lit(1), F.length(c) - F.col(f"_cut.{r}"))
        rows = rows.withColumns({"r1": short("r1", "r1"), "q1": short("q1", "r1"), "r2": short("r2", "r2"), "q2": short("q2", "r2")}).drop("_cut")

    def passes(seq, qual):
        n, low = F.length(seq), F.size(F.filter(S.phred(F.col(qual)), lambda q: q < qualified))
        total = F.aggregate(S.phred(F.col(qual)), F.lit(0), lambda a, q: a + q)
        return (n >= max(least, 1)) & (low * 100.0 <= n * float(unqualified_percent)) & (total >= n * float(mean_quality)) & (S.n_count(F.col(seq)) <= max_n)

    return rows.filter(passes("r1", "q1") & passes("r2", "q2"))
