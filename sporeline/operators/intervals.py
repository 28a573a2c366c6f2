"""Interval merging, multi-hit ids, and region extraction with an audit trail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sporeline.functions import seq as S
from sporeline.operators import graph

REGIONS = ("SSU", "ITS1", "S58", "ITS2", "LSU")


def merge(hits: DataFrame) -> DataFrame:
    """(id, start, end, n): islands of hits(id, start, end); touching intervals merge.

    Hits are sorted into ranges by id and place, so an id of very many hits lies in several; what the ranges before have
    reached of an id, and how many islands they began, one row each for a range and id, is carried into the next.
    """
    parts = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("id"), F.col("start"), F.col("end")]
    rows = graph.settled(hits.select("id", "start", "end").repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    within = W.partitionBy("_part", "id").orderBy("start", "end")
    earlier = W.partitionBy("id").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)

    def carried(df: DataFrame, value: Column, over) -> DataFrame:
        sums = df.groupBy("_part", "id").agg(value.alias("_v")).withColumn("_before", over(F.col("_v")).over(earlier))
        sums = sums.select(F.col("_part").alias("_p"), F.col("id").alias("_id"), "_before")
        return df.join(sums, (F.col("_part") == F.col("_p")) & F.col("id").eqNullSafe(F.col("_id"))).drop("_p", "_id")

    reached = carried(rows, F.max("end"), F.max)
    far = F.greatest(F.max("end").over(within.rowsBetween(W.unboundedPreceding, -1)), F.col("_before"))
    new = F.coalesce((F.col("start") > far).cast("int"), F.lit(1))
    marked = graph.settled(reached.select("_part", "id", "start", "end", new.alias("new")))
    begun = carried(marked, F.sum("new"), F.sum)
    number = F.sum("new").over(within.rowsBetween(W.unboundedPreceding, W.currentRow)) + F.coalesce("_before", F.lit(0))
    out = begun.withColumn("island", number)
    return out.groupBy("id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")).drop("island")


def multi_hit(hits: DataFrame) -> DataFrame:
    """(id, islands) of ids with more than one island: artefacts when hits are primer sites."""
    return merge(hits).groupBy("id").agg(F.count("*").alias("islands")).filter("islands > 1")


LABELS = {"SSU": "SSU", "ITS1": "ITS1", "S58": "5.8S", "ITS2": "ITS2", "LSU": "LSU"}
#: Markers that stand where a region has no coordinates.
MARKERS = ("not found", "no end", "no start", "overlap lsu", "overlap ssu")


def parse_region(text: Column, label: str, length: Column) -> Column:
    """struct(status, start, end, length) of 'LABEL: a-b' or a marker, against a sequence's length.

    Statuses in rising precedence: malformed, missing, a marker's own, nonfinite, nonpositive, invalid_length (the end is
    not after the start), out_of_bounds, valid.
    """
    raw = F.trim(text)
    prefix = f"{label}:"
    value = F.when(raw.startswith(prefix), F.trim(F.substring(raw, len(prefix) + 1, F.length(raw))))
    marker = F.lower(value).isin(*MARKERS)
    ends = [F.regexp_extract(value, r"^([+-]?[0-9]+)\s*-\s*([+-]?[0-9]+)$", k).try_cast("double") for k in (1, 2)]

    def checked(x: Column) -> Column:
        start, end = x["start"], x["end"]
        finite = start.isNotNull() & (F.abs(start) < float("inf")) & (F.abs(end) < float("inf"))
        status = (
            F.when(text.isNull() | (raw == ""), "missing").when(marker, F.replace(F.lower(value), F.lit(" "), F.lit("_")))
            .when(start.isNull() | end.isNull(), "malformed").when(~finite, "nonfinite").when((start <= 0) | (end <= 0), "nonpositive")
            .when(end <= start, "invalid_length").when((start > length) | (end > length), "out_of_bounds").otherwise("valid")
        )
        return F.struct(status.alias("status"), start.alias("start"), end.alias("end"), F.when(finite, end - start + 1).alias("length"))

    return S.let(F.struct(ends[0].alias("start"), ends[1].alias("end")), checked)


def parse_length(text: Column) -> Column:
    """Bases of 'N bp.'; null if it isn't a number."""
    return F.trim(F.regexp_replace(text, r"\s*bp\.?\s*$", "")).try_cast("long")


def audit(seqs: DataFrame, positions: DataFrame, region: str = "ITS") -> DataFrame:
    """seqs(id, seq) with each region's struct, start, end, reasons and a status, from positions(id, length, SSU, ITS1, S58,
    ITS2, LSU, info); at most one row of positions for an id.

    Reasons are joined by ';' in rule order; a sequence with any reason is excluded, others are extracted.
    """
    own = positions.select("id", F.lit(True).alias("there"), "length", "info", *[F.col(r).alias(f"raw_{r}") for r in REGIONS])
    rows = seqs.select("id", "seq").join(own, "id", "left").withColumn("there", F.coalesce("there", F.lit(False)))
    bases = F.length("seq")
    rows = rows.withColumn("length", parse_length(F.col("length")))
    rows = rows.withColumns({r: parse_region(F.col(f"raw_{r}"), LABELS[r], bases) for r in REGIONS})

    def rule(test: Column, reason: str) -> Column:
        return F.when(F.col("there") & test, F.lit(reason))

    rules = [F.when(~F.col("there"), F.lit("no_positions")), rule(F.col("length").isNull() | (F.col("length") <= 0), "invalid_itsx_length")]
    rules += [rule(F.col("length") != bases, "sequence_length_mismatch"), rule(F.lower("info").contains("chimeric"), "chimeric")]
    for r in REGIONS:
        start, end, status = (F.col(f"{r}.{x}") for x in ("start", "end", "status"))
        rules.append(rule(status == "malformed", f"malformed_{r}_coordinates"))
        rules.append(rule(status == "nonfinite", f"nonfinite_{r}_coordinates"))
        finite = F.col(f"{r}.length").isNotNull()
        rules.append(rule(finite & ((start <= 0) | (end <= 0)), f"nonpositive_{r}_coordinates"))
        rules.append(rule(finite & (end <= start), f"invalid_{r}_length"))
        rules.append(rule(finite & ((start > bases) | (end > bases)), f"out_of_bounds_{r}_coordinates"))
    for i, left in enumerate(REGIONS):
        for right in REGIONS[i + 1 :]:
            both = (F.col(f"{left}.status") == "valid") & (F.col(f"{right}.status") == "valid")
            late = F.col(f"{left}.start") >= F.col(f"{right}.start")
            rules.append(rule(both & late, f"out_of_order_{left}_{right}"))
            rules.append(rule(both & ~late & (F.col(f"{left}.end") >= F.col(f"{right}.start")), f"overlap_{left}_{right}"))
    first, last = ("ITS1", "ITS2") if region == "ITS" else (region, region)
    for r in dict.fromkeys((first, last)):
        rules.append(rule(F.col(f"{r}.status").isin("missing", *[m.replace(" ", "_") for m in MARKERS]), f"{r}_not_detected"))
    status = {r: F.col(r).withField("status", F.when(~F.col("there"), "no_positions").otherwise(F.col(f"{r}.status"))) for r in REGIONS}
    # Generated, so that conditions on the outcome aren't pushed into the rules, which would be found anew for each.
    found = F.struct(F.concat_ws(";", F.array_compact(F.array(*rules))).alias("reasons"), *[c.alias(r) for r, c in status.items()])
    out = rows.select("id", "seq", "length", F.explode(F.array(found)).alias("found")).select("id", "seq", "length", *[f"found.{r}" for r in REGIONS], "found.reasons")
    out = out.withColumns({"start": F.col(f"{first}.start"), "end": F.col(f"{last}.end")})
    return out.withColumn("status", F.when(F.col("reasons") != "", "excluded").otherwise("extracted"))


def extract(audited: DataFrame) -> DataFrame:
    """(id, region_seq) of the extracted, by coordinates, 1-based inclusive; ITS runs from ITS1's start to ITS2's end."""
    seq = F.substring("seq", F.col("start").cast("int"), (F.col("end") - F.col("start") + 1).cast("int"))
    return audited.filter("status = 'extracted'").select("id", seq.alias("region_seq"))


def reason_histogram(audited: DataFrame) -> DataFrame:
    each = audited.filter(F.col("reasons") != "").select(F.explode(F.split("reasons", ";")).alias("reason"))
    return each.groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")
