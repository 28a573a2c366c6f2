"""Chimera models of two parents, from a few candidates for each sequence.

A sequence is cut into four chunks. Each files its rarest bits, those with the least count in a sketch of the parents'
bits, longer ones the more bases the parents have, and parents look under all of theirs; a chunk's candidates are the ``few`` parents with the most of its bits. So no
task holds all parents, and a region that they all have in common pairs no one with everyone. The candidates, 4 * few at
most, are aligned with the sequence, gaps included; the best stretch from one's start and the best one up to another's end
give the crossing, and both vote on either side of it.

De novo, only clean sequences that are ``abskew`` times as abundant in the sample are parents. A sequence is judged as soon
as all those it met are, so rounds number at most the logarithm of the abundances to base ``abskew``, and one.

Null and empty sequences are clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.operators import candidates, graph

CHUNKS = 4
#: Bits that a chunk files, of at most so many bases; parents that a chunk chooses.
BITS, LONGEST, FEW = 4, 16, 8


def _aligned(q, p):
    """p's base for each of q's, 0 where p has none, by an alignment with the fewest edits; by position if lengths agree."""
    n, m = len(q), len(p)
    if n == m:
        return p
    steps = np.arange(m + 1, dtype=np.int32)
    cost = np.empty((n + 1, m + 1), np.int32)
    cost[0] = steps
    for i in range(1, n + 1):
        cost[i, 0] = i
        cost[i, 1:] = np.minimum(cost[i - 1, :-1] + (p != q[i - 1]), cost[i - 1, 1:] + 1)
        cost[i] = np.minimum.accumulate(cost[i] - steps) + steps
    out, i, j = np.zeros(n, np.uint8), n, m
    while i:
        if j and cost[i, j] == cost[i - 1, j - 1] + (p[j - 1] != q[i - 1]):
            i, j = i - 1, j - 1
            out[i] = p[j]
        elif cost[i, j] == cost[i - 1, j] + 1:
            i -= 1
        else:
            j -= 1
    return out


def bits_of(length: int, bases: int = 0) -> list[tuple[int, int, int, int]]:
    """(first, last, bits, bases of a bit) of each chunk of a sequence, against parents of so many bases: there are more bits
    of a length than that, where a chunk has room, so that chance makes no more candidates the more parents there are."""
    told = next((k for k in range(1, LONGEST) if 4**k >= bases), LONGEST)
    out = []
    for c in range(CHUNKS):
        first, last = c * length // CHUNKS, (c + 1) * length // CHUNKS
        k = next((k for k in candidates.MENU if k <= LONGEST and k * BITS <= last - first), 1)
        k = max(k, min(told, last - first))
        if last > first:
            out.append((first, last, min(BITS, (last - first) // k), k))
    return out


def _file(menu: list[int], table, bases: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        for batch in batches:
            keys, ids, chunks = [], [], []
            lots: dict[int, list] = {}
            for id_, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lots.setdefault(len(s), []).append((id_, s.encode()))
            for length, lot in lots.items():
                step = max(1, candidates.CELLS // length)
                for part in (lot[a : a + step] for a in range(0, len(lot), step)):
                    for chunk, (first, last, need, k) in enumerate(bits_of(length, bases)):
                        codes = np.stack([candidates._codes(s, k) for _, s in part])
                        cost = counts[menu.index(k)][candidates._counter(codes)].astype(np.float64)
                        for i, chosen in enumerate(candidates.rarest({k: cost}, first, last, need)):
                            keys += [int(codes[i, at].view(np.int64)) for at, _ in chosen]
                            ids += [part[i][0]] * len(chosen)
                            chunks += [chunk] * len(chosen)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(chunks, pa.int32())], ["key", "q_id", "chunk"])

    return run


def _met(queries: DataFrame, parents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, q_id, chunk) of queries(id, seq), and (key, p_id) of parents(id, seq)."""
    spark = queries.sparkSession
    lengths = queries.select(F.length("seq").alias("n")).distinct()
    bases = parents.agg(F.sum(F.length("seq"))).first()[0] or 0
    menu = sorted({k for r in lengths.toLocalIterator() for _, _, _, k in bits_of(r.n, bases)}) or [1]
    table = spark.sparkContext.broadcast(candidates._sketch(parents, menu))
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    filed = graph.settled(queries.select("id", "seq").repartition(tasks).mapInArrow(_file(menu, table, bases), "key long, q_id long, chunk int"))
    there = spark.sparkContext.broadcast(candidates.marks(filed))
    looked = parents.select("id", "seq").repartition(tasks).mapInArrow(candidates._look(dict.fromkeys(menu, 0), there), "key long, v_id long, v_at int")
    # The files' size says nothing of the bits', so neither side may be taken for small.
    return filed, looked.select("key", F.col("v_id").alias("p_id")).distinct().hint("merge")


def _votes(q, pa, pb, cut: int, xn: float, dn: float, mindiffs: int, mindiv: float):
    """(score, firm): the product of both sides' votes; firm with enough votes and divergence from the nearer parent."""
    score, firm = 1.0, True
    for x, y, at in ((pa, pb, slice(0, cut + 1)), (pb, pa, slice(cut + 1, None))):
        yes = int(((q[at] == x[at]) & (q[at] != y[at])).sum())
        no = int(((q[at] != x[at]) & (q[at] == y[at])).sum())
        other = int(((q[at] != x[at]) & (q[at] != y[at])).sum())
        score *= yes / (xn * (no + dn) + other)
        firm &= yes >= mindiffs
    model = int((q[: cut + 1] == pa[: cut + 1]).sum() + (q[cut + 1 :] == pb[cut + 1 :]).sum())
    nearer = max(int((q == pa).sum()), int((q == pb).sum()))
    return score, firm and 100.0 * (model - nearer) >= mindiv * nearer


def model(q: np.ndarray, parents: list[np.ndarray], xn: float, dn: float, mindiffs: int, mindiv: float) -> tuple[float, bool]:
    """(score, firm) of the best model of two of the parents; (0, False) if one parent is best on both sides."""
    if len(parents) < 2 or len(q) < 2:
        return 0.0, False
    rows = np.stack([_aligned(q, p) for p in parents])
    same = rows == q
    heads, tails = np.cumsum(same, 1), np.cumsum(same[:, ::-1], 1)[:, ::-1]
    cut = int((heads[:, :-1].max(0) + tails[:, 1:].max(0)).argmax())
    a, b = int(heads[:, cut].argmax()), int(tails[:, cut + 1].argmax())
    return _votes(q, rows[a], rows[b], cut, xn, dn, mindiffs, mindiv) if a != b else (0.0, False)


def _judge(xn: float, dn: float, mindiffs: int, mindiv: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, firms = [], []
            for seq, parents in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                score, firm = model(_bytes([seq])[0], _bytes([p["seq"] for p in parents or ()]), xn, dn, mindiffs, mindiv)
                scores.append(float(score))
                firms.append(bool(firm))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(firms, pa.bool_())], ["id", "score", "firm"])

    return run


def _bytes(seqs) -> list[np.ndarray]:
    return [np.frombuffer(s.encode(), np.uint8) for s in seqs]


def _chosen(hits: DataFrame, few: int) -> DataFrame:
    """(q_id, p_id) of hits(q_id, chunk, p_id, shared, first): each chunk's few parents with the most bits, then the first. Partial
    lists of at most ``few`` are merged, so a chunk that very many parents meet isn't held whole."""
    ranked = F.struct((-F.col("shared")).alias("s"), "first", "p_id")
    dealt = hits.select("q_id", "chunk", ranked.alias("r"), F.pmod(F.xxhash64("p_id"), F.lit(64)).alias("salt"))
    for keys in (("q_id", "chunk", "salt"), ("q_id", "chunk")):
        least = F.slice(F.array_sort(F.collect_list("r")), 1, few)
        dealt = dealt.groupBy(*keys).agg(least.alias("rs")).select(*keys, F.explode("rs").alias("r"))
    return dealt.select("q_id", "r.p_id").distinct()


def _scored(queries: DataFrame, chosen: DataFrame, parents: DataFrame, judge) -> DataFrame:
    """(id, score, firm) of queries(id, seq): parents(id, seq, first) stand in the order of ``first``, then of sequence."""
    named = chosen.join(parents.select(F.col("id").alias("p_id"), "first", F.col("seq").alias("p")), "p_id")
    lists = named.groupBy("q_id").agg(F.array_sort(F.collect_list(F.struct("first", F.col("p").alias("seq")))).alias("parents"))
    return queries.join(lists, queries.id == lists.q_id).select("id", "seq", "parents").mapInArrow(judge, "id long, score double, firm boolean")


def denovo_chimeras(
    seqs: DataFrame, abskew: float = 2.0, minh: float = 0.28, xn: float = 8.0, dn: float = 1.4, mindiffs: int = 3, mindiv: float = 0.8, few: int = FEW
) -> DataFrame:
    """(SampleID, seq, score, chimera) of seqs(SampleID, seq, size), distinct: each sequence against models of two more
    abundant clean parents in its sample, scored by the votes for and against on both sides of the best crossing."""
    rows = graph.settled(seqs.select("SampleID", "seq", "size").withColumn("id", F.monotonically_increasing_id()))
    real = rows.filter("seq <> ''")
    filed, looked = _met(real, real)
    of = lambda side: real.select(F.col("id").alias(f"{side}_id"), F.col("SampleID").alias(f"{side}_sample"), F.col("size").alias(f"{side}_size"))
    # The sample is part of the key, so that samples don't meet; a null sample is one, too.
    key = lambda df, side: df.join(of(side), f"{side}_id").withColumn("sample", F.coalesce(F.col(f"{side}_sample"), F.lit("\0")))
    both = key(filed, "q").join(key(looked, "p"), ["key", "sample"]).filter(F.col("p_size") >= abskew * F.col("q_size"))
    hits = graph.settled(both.groupBy("q_id", "chunk", "p_id", "p_size").agg(F.count("*").alias("shared")).withColumn("first", -F.col("p_size")))
    judge = _judge(xn, dn, mindiffs, mindiv)
    parents = real.select("id", "seq", (-F.col("size")).alias("first"))
    waiting = graph.settled(hits.select("q_id", "p_id").distinct())
    done = graph.settled(rows.join(waiting.select(F.col("q_id").alias("id")), "id", "left_anti").select("id", F.lit(0.0).alias("score")))
    while True:
        left = waiting.join(done.select(F.col("id").alias("q_id")), "q_id", "left_anti")
        unknown = left.join(done.select(F.col("id").alias("p_id"), "score"), "p_id", "left")
        ready = graph.settled(unknown.groupBy("q_id").agg(F.bool_or(F.col("score").isNull()).alias("waits")).filter("not waits").select("q_id"))
        if ready.isEmpty():
            break
        clean = done.filter(F.col("score") < minh).select(F.col("id").alias("p_id"))
        chosen = _chosen(hits.join(ready, "q_id").join(clean, "p_id"), few)
        asked = real.join(ready.select(F.col("q_id").alias("id")), "id")
        found = _scored(asked, chosen, parents, judge).select("id", F.when(F.col("firm"), F.col("score")).otherwise(F.lit(0.0)).alias("s"))
        new = graph.settled(asked.select("id").join(found, "id", "left").select("id", F.coalesce("s", F.lit(0.0)).alias("score")))
        done = done.union(new)
    return rows.join(done, "id").select("SampleID", "seq", "score", (F.col("score") >= minh).alias("chimera"))


def reference_chimeras(
    seqs: DataFrame, references: DataFrame, minh: float = 0.28, xn: float = 8.0, dn: float = 1.4, mindiffs: int = 3, mindiv: float = 0.8, few: int = FEW
) -> DataFrame:
    """seqs(seq, ...) with score and verdict: 'chimera', 'borderline' (a score of ``minh`` without the votes or the
    divergence; kept with the clean ones) or 'clean', against models of two of references(seq). A reference that equals
    the sequence is no parent. Each distinct sequence is judged once; of any number of references none is collected."""
    queries = graph.settled(seqs.select("seq").filter("seq <> ''").distinct().withColumn("id", F.monotonically_increasing_id()))
    parents = graph.settled(references.select("seq").filter("seq <> ''").distinct().withColumn("id", F.monotonically_increasing_id()).withColumn("first", F.lit(0)))
    filed, looked = _met(queries, parents)
    own = queries.select("id", F.col("seq")).join(parents.select("seq", F.col("id").alias("p_id")), "seq").select(F.col("id").alias("q_id"), "p_id")
    hits = filed.join(looked, "key").groupBy("q_id", "chunk", "p_id").agg(F.count("*").alias("shared")).join(own, ["q_id", "p_id"], "left_anti").withColumn("first", F.lit(0))
    scored = _scored(queries, _chosen(hits, few), parents, _judge(xn, dn, mindiffs, mindiv))
    verdict = F.when(F.col("score") < minh, "clean").when(F.col("firm"), "chimera").otherwise("borderline")
    found = queries.join(scored, "id").select(F.col("seq").alias("_of"), "score", verdict.alias("verdict"))
    out = seqs.join(found, seqs.seq == found["_of"], "left").drop("_of")
    return out.withColumns({"score": F.coalesce("score", F.lit(0.0)), "verdict": F.coalesce("verdict", F.lit("clean"))})
