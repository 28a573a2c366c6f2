"""K1: barcodes called by local alignment at reads' ends, with tags of any lengths.

A tag and an end window are aligned only where they share a bit: an alignment that reaches the least score has so few
errors that some run of it without one is at least ``seed`` bases, which follows from the scores, so no call is missed.
Bits meet by an equi-join; alignments run for many pairs at once in each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.functions import seq as S
from sporeline.operators import align, graph
from sporeline.operators.tags import _listed

#: Pairs of a tag and a window that are aligned at once.
LOT = 2_000


def seed(length: int, least: float, s: align.Local = align.Local()) -> int:
    """Bases of the longest run without errors that an alignment of a tag of ``length`` has at least, at a score of ``least``
    percent: with e errors, each of which costs the cheapest at least, m matches make at most m * match - e * cost."""
    need = least / 100 * s.match * length
    cost = min(s.mismatch, s.insertion, s.deletion)
    shortest, errors = length, 0
    while s.match * length - cost * errors >= need - 1e-9:
        matches = -(-int(np.ceil(need - 1e-9) + cost * errors) // s.match)
        shortest = min(shortest, -(-matches // (errors + 1)))
        errors += 1
    return max(1, shortest)


def calls(reads: DataFrame, tags: DataFrame, window: int = 70, least_score: float = 70.0, least_span: float = 0.75, least_lead: float = 0.0) -> DataFrame:
    """(row, side, tag, score, span, stop) of reads(row, seq) and tags(tag, seq): the best tag of each read's end, by score in
    percent of a perfect match, then by name, if ``least_span`` of its bases are aligned and no other tag comes within
    ``least_lead``. Side 5 is the read's start, 3 the reverse complement of its end; stop is where the tag ends from there.
    """
    coded = tags.select("tag", F.upper("seq").alias("t")).filter("t <> ''")
    lengths = [r.n for r in coded.select(F.length("t").alias("n")).distinct().orderBy("n").toLocalIterator()]
    seeds = {n: seed(n, least_score) for n in lengths}
    if not seeds:
        return reads.sparkSession.createDataFrame([], "row long, side int, tag string, score double, span double, stop int")
    of = F.create_map(*[F.lit(x) for n in seeds.items() for x in n])[F.length("t")]
    bits = lambda c, q: F.when(F.length(c) >= q, F.transform(F.sequence(F.lit(1), F.length(c) - q + 1), lambda i: F.substring(c, i, q))).otherwise(F.array().cast("array<string>"))
    own = coded.withColumn("q", of).select("tag", "t", "q", F.explode(F.array_distinct(bits(F.col("t"), F.col("q")))).alias("bit"))
    ends = reads.filter("seq <> ''").select("row", F.explode(F.array(
        F.struct(F.lit(5).alias("side"), F.substring(F.upper("seq"), 1, window).alias("w")),
        F.struct(F.lit(3).alias("side"), S.revcomp(F.expr(f"right(upper(seq), {window})")).alias("w")),
    )).alias("e")).select("row", "e.*")
    ends = graph.settled(ends)
    asked = None
    for q in sorted(set(seeds.values())):
        part = ends.select("row", "side", "w", F.lit(q).alias("q"), F.explode(F.array_distinct(bits(F.col("w"), F.lit(q)))).alias("bit"))
        asked = part if asked is None else asked.union(part)
    met = asked.join(_listed(own), ["q", "bit"]).select("row", "side", "w", "tag", "t").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, LOT):
                b = whole.slice(at, LOT)
                t, w = ([x.encode() for x in b.column(i).to_pylist()] for i in (4, 2))
                found = align.local(t, w)
                size = np.array([len(x) for x in t])
                score = 100.0 * found[:, 0] / (align.Local().match * size)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(score), pa.array(found[:, 1] / size), pa.array(found[:, 2].astype(np.int32))], ["row", "side", "tag", "score", "span", "stop"])

    tasks = max(reads.sparkSession.sparkContext.defaultParallelism, int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    scored = met.repartition(tasks, "row", "side", "tag").mapInArrow(run, "row long, side int, tag string, score double, span double, stop int")
    good = scored.filter((F.col("score") >= least_score - 1e-9) & (F.col("span") >= least_span - 1e-9))
    # The two best names of each end, by partial lists of two.
    two = lambda c: F.slice(F.array_sort(c), 1, 2)
    ranked = good.groupBy("row", "side").agg(two(F.collect_list(F.struct((-F.col("score")).alias("s"), "tag", "span", "stop"))).alias("b"))
    lead = F.get("b", F.lit(1))["s"] - F.get("b", F.lit(0))["s"]
    ranked = ranked.filter((F.size("b") == 1) | (lead >= least_lead - 1e-9))
    first = F.get("b", F.lit(0))
    return ranked.select("row", "side", first["tag"].alias("tag"), (-first["s"]).alias("score"), first["span"].alias("span"), first["stop"].alias("stop"))


def demultiplex_aligned(reads: DataFrame, tags: DataFrame, samples: DataFrame, kind: str = "dual", trim: bool = True, **scores) -> DataFrame:
    """reads(id, seq, ...) with sample and the ends' scores. Kinds: 'single': samples(sample, tag1), the better end's tag counts,
    the read's start if equal; 'dual': samples(sample, tag1, tag2) in either orientation (a symmetric pair is the same tag
    twice). With trim, seq is cut to what lies between the tags; reads without a sample go. Ids may repeat."""
    if kind not in ("single", "dual"):
        raise ValueError(f"kind: {kind}")
    rows = graph.settled(reads.withColumn("_row", F.monotonically_increasing_id()))
    found = graph.settled(calls(rows.select(F.col("_row").alias("row"), "seq"), tags, **scores))
    side = lambda n: found.filter(F.col("side") == n).select(F.col("row").alias("_row"), F.col("tag").alias(f"tag_{n}"), F.col("score").alias(f"score_{n}"), F.col("stop").alias(f"stop_{n}"))
    both = rows.join(side(5), "_row", "left").join(side(3), "_row", "left")
    if kind == "single":
        better = F.coalesce(F.col("score_5"), F.lit(-1.0)) >= F.coalesce(F.col("score_3"), F.lit(-1.0))
        both = both.withColumn("_tag", F.when(better, F.col("tag_5")).otherwise(F.col("tag_3")))
        both = both.withColumns({"stop_5": F.when(better, F.col("stop_5")), "stop_3": F.when(~better, F.col("stop_3"))})
        out = both.join(samples.select("sample", F.col("tag1").alias("_tag")), "_tag")
    else:
        pairs = samples.select("sample", F.col("tag1").alias("tag_5"), F.col("tag2").alias("tag_3"))
        pairs = pairs.union(samples.select("sample", "tag2", "tag1")).distinct()
        out = both.join(pairs, ["tag_5", "tag_3"])
    if trim:
        start, stop = F.coalesce("stop_5", F.lit(0)), F.coalesce("stop_3", F.lit(0))
        out = out.withColumn("seq", F.substring(F.col("seq"), start + 1, F.greatest(F.length("seq") - start - stop, F.lit(0))))
    return out.select("sample", *reads.columns, "score_5", "score_3")
