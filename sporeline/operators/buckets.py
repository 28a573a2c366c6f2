"""Buckets of balanced size, chunks and budgeted samples."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.operators.ranks import global_rank, running


def bucket_count(n_seqs: int, longest: int, limit: int = 2**31) -> int:
    """Buckets so that none holds more than ``limit`` bases."""
    return max(1, -(-n_seqs * longest // limit))


def cluster_stats(members: DataFrame) -> DataFrame:
    """(Cluster, num_seqs, sum_len) of members(Cluster, seq)."""
    return members.groupBy("Cluster").agg(F.count("*").alias("num_seqs"), F.sum(F.length("seq")).alias("sum_len"))


#: Clusters that are packed one by one; what is left is dealt in bulk.
HEAD = 10_000


def pack(stats: DataFrame, n: int, head: int = HEAD) -> DataFrame:
    """(Cluster, BucketID): the largest cluster left goes to the lightest bucket, the lowest number among equals, for the
    ``head`` largest clusters. The smaller ones fill the buckets to one level in the order of size: a running sum over
    ranges says which bucket's room a cluster begins in.

    No bucket exceeds the level, or what the large ones make of it, by more than one of the smaller clusters. The driver
    holds ``head`` clusters and a number for each bucket.
    """
    order = [F.desc("sum_len"), F.desc("num_seqs"), F.asc("Cluster")]
    first = stats.orderBy(*order).limit(head).select("Cluster", "num_seqs", "sum_len").collect()
    heap = [(0, b) for b in range(1, n + 1)]
    out = []
    for row in first:
        load, b = heapq.heappop(heap)
        out.append((row.Cluster, b))
        heapq.heappush(heap, (load + row.sum_len, b))
    schema = f"Cluster {stats.schema['Cluster'].dataType.simpleString()}, BucketID int"
    large = stats.sparkSession.createDataFrame(out, schema)
    if len(first) < head:
        return large
    last = first[-1]
    at = F.struct((-F.col("sum_len")).cast("long").alias("s"), (-F.col("num_seqs")).cast("long").alias("q"), "Cluster")
    end = F.struct(F.lit(-last.sum_len).cast("long").alias("s"), F.lit(-last.num_seqs).cast("long").alias("q"), F.lit(last.Cluster).cast(stats.schema["Cluster"].dataType).alias("Cluster"))
    small = stats.filter(at > end)
    room = small.agg(F.coalesce(F.sum("sum_len"), F.lit(0))).first()[0]
    loads = sorted(heap)
    # The level to which ``room`` fills the lightest buckets.
    filled = 0
    level = 0.0
    for i, (load, _) in enumerate(loads, 1):
        filled += load
        level = (filled + room) / i
        if i == n or level <= loads[i][0]:
            break
    ends, total = [], 0.0
    for load, _ in loads:
        total += max(0.0, level - load)
        ends.append(total)
    which = F.least(F.size(F.filter(F.array(*map(F.lit, ends)), lambda x: x <= F.col("before"))), F.lit(n - 1))
    named = F.array(*[F.lit(b) for _, b in loads])
    dealt = running(small.select("Cluster", "num_seqs", "sum_len"), order, F.col("sum_len"))
    return large.union(dealt.select("Cluster", F.get(named, which).alias("BucketID")))


def bucket_summary(stats: DataFrame, buckets: DataFrame) -> DataFrame:
    """(BucketID, Num_clusters, num_seqs, sum_len and its share in basis points)."""
    out = stats.join(buckets, "Cluster").groupBy("BucketID").agg(
        F.count("*").alias("Num_clusters"), F.sum("num_seqs").alias("num_seqs"), F.sum("sum_len").alias("sum_len")
    )
    whole = out.agg(F.sum("sum_len").alias("whole"))
    return out.crossJoin(F.broadcast(whole)).withColumn("sum_len_bp", F.expr("10000 * sum_len div whole")).drop("whole")


def fractions(reads: DataFrame, by: str, share: float) -> DataFrame:
    """(by, reads, fraction): a common share, but one read a group in expectation, and never over 1."""
    out = reads.groupBy(by).agg(F.count("*").alias("reads"))
    return out.withColumn("fraction", F.least(F.lit(1.0), F.greatest(F.lit(share), F.lit(1.0) / F.col("reads"))))


def sample(reads: DataFrame, by: str, share: float, seed: int = 111) -> DataFrame:
    """Reads sampled by the fractions; a sampling operator. Groups are joined as Spark sees fit, by their number."""
    f = fractions(reads, by, share).select(F.col(by).alias("_by"), "fraction")
    return reads.join(f, reads[by].eqNullSafe(f["_by"])).filter(F.rand(seed) < F.col("fraction")).drop("fraction", "_by")


def within_budget(rows: DataFrame, order: list, size: str, budget: int) -> DataFrame:
    """The first rows in ``order`` (without ties) until their sizes reach the budget, the row that crosses it included."""
    return running(rows, order, F.col(size)).filter(F.col("before") < budget).select(*rows.columns)


def chunks(rows: DataFrame, order: str, n: int) -> DataFrame:
    """rows with ``chunk``: n consecutive rows each, by a global rank in two steps (ranges, then rows within)."""
    return global_rank(rows, order).withColumn("chunk", F.floor((F.col("rank") - 1) / n).cast("long")).drop("rank")
