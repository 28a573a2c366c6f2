"""Tag-jump (cross-talk) scores over a long abundance table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.functions.seq import uncross


def scores(cells: DataFrame, f: float = 0.01, p: float = 1.0, least: float = 0.1) -> DataFrame:
    """(OTU, SampleID, Abundance, Total, Score, TagJump) of cells(OTU, SampleID, Abundance).

    Cells without an OTU are dropped. Totals come from an aggregate and a join rather than a window, so an OTU that is
    in very many samples is no single task; the number of samples is one row.
    """
    a = cells.filter(F.col("OTU").isNotNull()).groupBy("OTU", "SampleID").agg(F.sum("Abundance").alias("Abundance"))
    totals = a.groupBy("OTU").agg(F.sum("Abundance").alias("Total"))
    n = a.agg(F.count_distinct("SampleID").alias("n_samples"))
    out = a.join(totals, "OTU").crossJoin(F.broadcast(n))
    score = uncross(F.col("Abundance"), F.col("Total"), F.col("n_samples"), f, p)
    return out.select("OTU", "SampleID", "Abundance", "Total", score.alias("Score"), (score >= least).alias("TagJump"))


def filtered(scored: DataFrame) -> DataFrame:
    """The cells that are no tag jump; those without a verdict are dropped."""
    return scored.filter(~F.col("TagJump")).select("OTU", "SampleID", "Abundance")


def flag(rows: DataFrame, scored: DataFrame) -> DataFrame:
    """rows(OTU, SampleID, ...) with TagJump; scored has one row for each cell, so no row is multiplied."""
    return rows.join(scored.select("OTU", "SampleID", "TagJump"), ["OTU", "SampleID"], "left")


def stats(scored: DataFrame) -> DataFrame:
    """One row: reads, events, reads in events and their share in basis points."""
    jump = F.coalesce("TagJump", F.lit(False))
    out = scored.agg(
        F.coalesce(F.sum("Abundance"), F.lit(0)).alias("total_reads"),
        F.count_if(jump).alias("events"),
        F.coalesce(F.sum(F.when(jump, F.col("Abundance"))), F.lit(0)).alias("tj_reads"),
    )
    return out.withColumn("tj_bp", F.expr("if(total_reads = 0, 0L, 10000 * tj_reads div total_reads)"))


def from_wide(wide: DataFrame, otu: str, samples: list[str]) -> DataFrame:
    """A wide table as cells with a positive abundance."""
    quoted = ["`" + s.replace("`", "``") + "`" for s in samples]
    long = wide.unpivot(otu, quoted, "SampleID", "Abundance")
    return long.filter("Abundance > 0").withColumnRenamed(otu, "OTU")


def from_sparse_wide(wide: DataFrame, otu: str) -> DataFrame:
    """wide(otu, cells), a map by sample in each row, as cells with a positive abundance."""
    return wide.select(F.col(otu).alias("OTU"), F.explode("cells").alias("SampleID", "Abundance")).filter("Abundance > 0")
