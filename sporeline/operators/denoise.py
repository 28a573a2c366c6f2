"""Error rates and true sequences by a model of substitution errors, over all sequences at once.

A unique sequence is an error of a centre with expectation E = rate * reads of the centre's cluster; its rate is the product
of the error matrix over the aligned bases. A sequence whose reads are too many for that (the chance of as many, given
that there is one, times the number of sequences of its bucket is under ``omega_a``) becomes a centre itself.

Where a partition algorithm splits off one sequence at a time, here every sequence that is significant, and more so than
all significant ones among its neighbours, is split off in the same round: only neighbours, the pairs alike enough for one
to be an error of the other, can change each other's expectation. So rounds are as many as the longest chain of ever less
significant neighbours, each a few joins over the links, and no bucket or sample is one task. Pairs less alike than
``IDENTITY`` have rate 0. Links and their base counts are made once; learning only weighs them anew.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sporeline.operators import align, candidates, graph

#: Least edit identity of two sequences of which one can be an error of the other.
IDENTITY = 0.9
#: Rounds in which members move to the centre that expects them most, and of learning, at most.
MOVES, CONSISTENT = 10, 10
BASES = "ACGT"


def links(derep: DataFrame, band: int = 16) -> DataFrame:
    """(bucket, seq, size, centre, centre_size, counts): for each sequence its neighbours in the bucket that have no fewer
    reads, and how often each base of the centre stands above each base of it. derep(bucket, seq, size), distinct."""
    met = candidates.pairs(derep.select("seq").distinct(), IDENTITY, groups=derep)
    # Pairs that only meet go before they are aligned: chance alone gives more of them than there are sequences.
    bound = F.floor(F.lit((1 - IDENTITY) / IDENTITY) * F.least(F.length("u"), F.length("v")) + 1e-9).cast("int")
    met = met.withColumn("_bound", bound).filter(F.expr("levenshtein(u, v, _bound) >= 0"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = ([x.encode() for x in batch.column(i).to_pylist()] for i in (0, 1))
            low, high = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
            # The band is about the diagonals on which the two share a bit.
            middle = (low + high) // 2
            counts = align.transitions(us, vs, np.maximum(low, middle - band), np.minimum(high, middle + band))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(counts), pa.list_(pa.int32()))], ["u", "v", "counts"])

    counted = graph.settled(met.select("u", "v", "low", "high").mapInArrow(run, "u string, v string, counts array<int>"))
    turned = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.get("counts", (i % 4) * 4 + F.floor(i / 4).cast("int")))
    both = counted.select(F.col("u").alias("centre"), F.col("v").alias("seq"), "counts").union(counted.select("v", "u", turned))
    centre = derep.select("bucket", F.col("seq").alias("centre"), F.col("size").alias("centre_size"))
    out = both.join(derep.select("bucket", "seq", "size"), "seq").join(centre, ["bucket", "centre"]).filter("centre_size >= size")
    return out.select("bucket", "seq", "size", "centre", "centre_size", "counts")


def start_matrix() -> np.ndarray:
    """What learning starts from: every error as likely as can be."""
    return np.ones((4, 4))


def estimated(counts: np.ndarray, pseudocount: int = 1) -> np.ndarray:
    """The error matrix, from base to base, of counts by reads."""
    counts = counts.reshape(4, 4) + pseudocount
    return counts / counts.sum(1, keepdims=True)


def _rate(err: np.ndarray) -> Column:
    """The product of the matrix over ``counts``."""
    logs = F.array(*[F.lit(float(x)) for x in np.log(np.maximum(err, 1e-300)).ravel()])
    return F.exp(F.aggregate(F.zip_with("counts", logs, lambda n, x: n * x), F.lit(0.0), lambda a, x: a + x))


def tail(reads: int, expected: float, given_one: bool = True) -> float:
    """P(X >= reads), X Poisson with mean ``expected``; by P(X >= 1) if ``given_one``."""
    if expected <= 0:
        return 0.0 if reads else 1.0
    if reads <= expected:  # not in question; the chance is large
        log, total = -expected, 0.0
        for k in range(reads):
            total += math.exp(log)
            log += math.log(expected / (k + 1))
        out = max(0.0, 1.0 - total)
    else:
        term = math.exp(reads * math.log(expected) - expected - math.lgamma(reads + 1))
        out, k = 0.0, reads
        while term > out * 1e-17:
            out += term
            k += 1
            term *= expected / k
    return min(1.0, out / -math.expm1(-expected)) if given_one else out


def _chances(rows: DataFrame, given_one: bool) -> DataFrame:
    """rows(size, expected, ...) with p."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, expected = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("size", "expected"))
            p = [tail(n, e, given_one) for n, e in zip(size, expected)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], [*batch.schema.names, "p"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, p double")


def _assigned(derep: DataFrame, rates: DataFrame, centres: DataFrame) -> DataFrame:
    """(bucket, seq, size, centre, expected): the centre of centres(bucket, centre, reads) that expects a sequence most; a
    centre is its own, and a sequence that none expects has none."""
    wanted = rates.join(centres, ["bucket", "centre"]).select("bucket", "seq", "centre", (F.col("rate") * F.col("reads")).alias("e"))
    best = wanted.filter("e > 0").groupBy("bucket", "seq").agg(F.min(F.struct((-F.col("e")).alias("e"), "centre")).alias("b"))
    own = centres.select("bucket", F.col("centre").alias("seq"), F.lit(True).alias("is_centre"))
    out = derep.join(best, ["bucket", "seq"], "left").join(own, ["bucket", "seq"], "left")
    return out.select(
        "bucket", "seq", "size", F.when(F.col("is_centre"), F.col("seq")).otherwise(F.col("b.centre")).alias("centre"),
        F.when(F.col("is_centre"), F.lit(None)).otherwise(F.coalesce(-F.col("b.e"), F.lit(0.0))).alias("expected"),
    )


def _settled_members(derep: DataFrame, rates: DataFrame, centres: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members and centres with their reads, once no member moves (or after MOVES rounds)."""
    for _ in range(MOVES):
        members = graph.settled(_assigned(derep, rates, centres))
        reads = members.filter("centre is not null").groupBy("bucket", "centre").agg(F.sum("size").alias("reads"))
        new = graph.settled(reads)
        if new.join(centres, ["bucket", "centre", "reads"], "left_anti").isEmpty():
            return members, new
        centres = new
    return members, centres


def infer(
    derep: DataFrame, err: np.ndarray, omega_a: float = 1e-20, omega_c: float = 1e-40, singletons: bool = False, near: DataFrame | None = None
) -> DataFrame:
    """(bucket, seq, size, centre, p) of derep(bucket, seq, size), distinct: what true sequence each is read from; null where
    its reads are too many for that (p < omega_c). ``near``: the result of ``links``."""
    derep = graph.settled(derep.select("bucket", "seq", "size"))
    near = graph.settled(links(derep)) if near is None else near
    rates = graph.settled(near.select("bucket", "seq", "centre", "centre_size", _rate(err).alias("rate")))
    tests = derep.groupBy("bucket").agg(F.count("*").alias("tests"))
    centres = derep.select("bucket", F.col("seq").alias("centre"), F.col("size").alias("reads")).limit(0)
    members = derep.select("bucket", "seq", "size", F.lit(None).cast("string").alias("centre"), F.lit(0.0).alias("expected"))
    while True:
        open_ = members.filter("expected is not null" if singletons else "expected is not null and size > 1").join(tests, "bucket")
        marked = graph.settled(_chances(open_, True).filter(F.col("p") * F.col("tests") < omega_a).select("bucket", "seq", "size", "p"))
        rank = F.struct("p", (-F.col("size")).alias("s"), "seq")
        of = lambda name: marked.select("bucket", F.col("seq").alias(name), rank.alias(f"{name}_rank"))
        both = rates.select("bucket", F.col("seq").alias("a"), F.col("centre").alias("b")).join(of("a"), ["bucket", "a"]).join(of("b"), ["bucket", "b"])
        later = both.select("bucket", F.when(F.col("a_rank") < F.col("b_rank"), F.col("b")).otherwise(F.col("a")).alias("seq")).distinct()
        new = graph.settled(marked.join(later, ["bucket", "seq"], "left_anti").select("bucket", F.col("seq").alias("centre"), F.col("size").alias("reads")))
        if new.isEmpty():
            break
        members, centres = _settled_members(derep, rates, centres.union(new))
    done = _chances(members.withColumn("expected", F.coalesce("expected", F.lit(-1.0))), False)
    own = F.col("seq") == F.col("centre")
    p = F.when(own, F.lit(1.0)).otherwise(F.col("p"))
    return done.select("bucket", "seq", "size", F.when(own | (F.col("p") >= omega_c), F.col("centre")).alias("centre"), p.alias("p"))


def _counts(members: DataFrame, near: DataFrame) -> np.ndarray:
    """Bases of centres above bases of reads, over all members."""
    kept = members.filter("centre is not null")
    moved = kept.filter("seq <> centre").join(near.select("bucket", "seq", "centre", "counts"), ["bucket", "seq", "centre"])
    by_link = moved.select("size", F.posexplode("counts").alias("i", "n")).groupBy("i").agg(F.sum(F.col("n") * F.col("size")).alias("n"))
    letters = [F.sum((F.length("seq") - F.length(F.replace(F.col("seq"), F.lit(c), F.lit("")))) * F.col("size")).alias(c) for c in BASES]
    own = kept.filter("seq = centre").agg(*letters).first()
    out = np.zeros(16)
    for r in by_link.collect():
        out[r.i] += r.n
    for i, c in enumerate(BASES):
        out[5 * i] += own[c] or 0
    return out


def learn(derep: DataFrame, omega_a: float = 1e-20, rounds: int = CONSISTENT, tolerance: float = 1e-8) -> tuple[np.ndarray, DataFrame]:
    """The error matrix of derep(bucket, seq, size) that its own inference gives again, and the links. In turn the true
    sequences are inferred by the matrix, and the matrix is estimated by the reads of each, with no read discarded. The first
    matrix takes every sequence for an error of its most abundant neighbour."""
    derep = graph.settled(derep.select("bucket", "seq", "size"))
    near = graph.settled(links(derep))
    heavy = F.min(F.struct((-F.col("centre_size")).alias("s"), "centre"))["centre"]
    upward = near.filter("centre_size > size").groupBy("bucket", "seq").agg(heavy.alias("centre"))
    first = derep.join(upward, ["bucket", "seq"], "left").withColumn("centre", F.coalesce("centre", "seq"))
    err = estimated(_counts(first, near))
    for _ in range(rounds):
        new = estimated(_counts(infer(derep, err, omega_a, 0.0, near=near), near))
        change, err = float(np.abs(new - err).max()), new
        if change < tolerance:
            break
    return err, near


def denoise(derep: DataFrame, omega_a: float = 1e-20, omega_c: float = 1e-40) -> DataFrame:
    """(bucket, id, target, size, seq) of derep(bucket, id, seq, size): target is the id of the true sequence (W10: the least id
    of its rows), null for what is discarded; for ``relational.denoise_summary`` (D22) and a pseudo-UC file (SNK11)."""
    unique = graph.settled(derep.groupBy("bucket", "seq").agg(F.sum("size").alias("size"), F.min("id").alias("first")))
    err, near = learn(unique, omega_a)
    found = infer(unique, err, omega_a, omega_c, near=near)
    names = unique.select("bucket", F.col("seq").alias("centre"), F.col("first").alias("target"))
    found = found.select("bucket", "seq", "centre").join(names, ["bucket", "centre"], "left").select("bucket", "seq", "target")
    return derep.join(found, ["bucket", "seq"]).select("bucket", "id", "target", "size", "seq")
