"""OTU tables: long, wide, singleton filter, sequence-table assembly and aggregation."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replicate_name(sample: Column) -> Column:
    """The part after '__' of a Run__Sample id; null where there is none."""
    return F.when(F.instr(sample, "__") > 0, F.split_part(sample, F.lit("__"), F.lit(2)))


def mapped(seqtab: DataFrame, membership: DataFrame) -> DataFrame:
    """seqtab with OTU; rows without one are dropped. The map has one row for each SeqID."""
    return seqtab.join(membership.select("SeqID", "OTU"), "SeqID", "left").filter(F.col("OTU").isNotNull())


def singletons(joined: DataFrame) -> DataFrame:
    return joined.groupBy("OTU").agg(F.sum("Abundance").alias("n")).filter("n < 2").select("OTU")


def drop_singletons(joined: DataFrame, max_meep: float | None = 0.5) -> DataFrame:
    """joined without singleton OTUs; with a limit only those go whose representative's MEEP is over it, so an unknown
    MEEP is kept."""
    single = singletons(joined)
    if max_meep is not None:
        poor = joined.filter(F.col("SeqID") == F.col("OTU")).filter(F.col("MEEP") > max_meep).select("OTU")
        single = single.join(poor, "OTU", "left_semi")
    return joined.join(single, "OTU", "left_anti")


def long_table(joined: DataFrame, merge_replicates: bool = False) -> DataFrame:
    """(OTU, SampleID, Abundance); with merging, samples without '__' share a null sample."""
    sample = replicate_name(F.col("SampleID")) if merge_replicates else F.col("SampleID")
    return joined.groupBy("OTU", sample.alias("SampleID")).agg(F.sum("Abundance").alias("Abundance"))


#: The wide table's column of rows without a sample, as a pivot calls it.
NO_SAMPLE = "null"


def sample_names(long: DataFrame) -> list[str | None]:
    """All samples in order, None last. Columns have to differ in more than case, so names that don't are refused."""
    names = sorted((r.SampleID for r in long.select("SampleID").distinct().collect()), key=lambda s: (s is None, s or ""))
    columns = ["otu", *[(NO_SAMPLE if s is None else s).lower() for s in names]]
    if len(set(columns)) < len(columns):
        raise ValueError("samples' names clash as columns of a wide table")
    return names


def wide_table(long: DataFrame, samples: list[str | None]) -> DataFrame:
    """One column for each sample, 0 where it lacks the OTU."""
    wide = long.groupBy("OTU").pivot("SampleID", samples).agg(F.sum("Abundance"))
    own = wide.toDF("OTU", *[f"c{i}" for i in range(len(samples))])
    return own.select("OTU", *[F.coalesce(f"c{i}", F.lit(0)).alias(NO_SAMPLE if s is None else s) for i, s in enumerate(samples)])


def sparse_wide_table(long: DataFrame) -> DataFrame:
    """(OTU, cells): the wide table where samples are too many for columns: a row's map holds its own samples alone, so the
    table grows with the cells there are, not with OTUs times samples."""
    cells = long.groupBy("OTU", F.coalesce(F.col("SampleID").cast("string"), F.lit(NO_SAMPLE)).alias("SampleID")).agg(F.sum("Abundance").alias("Abundance"))
    return cells.groupBy("OTU").agg(F.map_from_entries(F.collect_list(F.struct("SampleID", "Abundance"))).alias("cells"))


def ranked(long: DataFrame) -> DataFrame:
    """(OTU, total) in falling order of abundance, then OTU."""
    return long.groupBy("OTU").agg(F.sum("Abundance").alias("total")).orderBy(F.desc("total"), "OTU")


def union_runs(runs: list[DataFrame]) -> DataFrame:
    """The rows of all runs; columns that a run lacks are null."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)


def aggregate_stats(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("n_rows"), F.count_distinct("SeqID").alias("n_seqs"), F.count_distinct("SampleID").alias("n_samples"),
        F.coalesce(F.sum("Abundance"), F.lit(0)).alias("n_reads"), F.max("DeNovo_Chimera_Score").alias("max_score"),
    )


def best_quality(quality: DataFrame) -> DataFrame:
    """Each SeqID's row of the best PhredScore (then least sample); ids with no score are dropped."""
    best = F.min(F.struct((-F.col("PhredScore")).alias("p"), "SampleID", "PhredScore", "MaxEE", "MEEP"))
    return quality.filter(F.col("PhredScore").isNotNull()).groupBy("SeqID").agg(best.alias("b")).select("SeqID", "b.PhredScore", "b.MaxEE", "b.MEEP")


def assemble(cells: DataFrame, quality: DataFrame, chimeras: DataFrame, sequences: DataFrame) -> DataFrame:
    """The long sequence table: cells(SeqID, SampleID, Abundance) with the sequence's best quality over all samples, the
    sample's own chimera score, and the sequence."""
    from sporeline.operators.chimera import attach_scores

    out = cells.join(best_quality(quality), "SeqID", "left")
    out = attach_scores(out, chimeras).join(sequences.select("SeqID", "Sequence"), "SeqID", "left")
    return out.select(
        F.concat_ws("___", "SeqID", "SampleID").alias("SeqID___SampleID"), "SampleID", "SeqID", "Abundance",
        F.length("Sequence").alias("SeqLen"), "PhredScore", "MaxEE", "MEEP", "DeNovo_Chimera", "DeNovo_Chimera_Score", "Sequence",
    )


def export_check(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """One row: ids wanted, exported and missing."""
    out = wanted.select("SeqID").join(have.select("SeqID", F.lit(1).alias("there")).distinct(), "SeqID", "left")
    return out.agg(F.count("*").alias("requested"), F.count("there").alias("exported"), F.count_if(F.col("there").isNull()).alias("missing"))


def duplicate_ids(rows: DataFrame) -> DataFrame:
    return rows.groupBy("SeqID").agg(F.count("*").alias("n")).filter("n > 1")


def unique_by_id(rows: DataFrame, order: str) -> DataFrame:
    """The first row, by an ordering column, of each SeqID. An aggregate, so no group is sorted."""
    rest = [c for c in rows.columns if c not in ("SeqID", order)]
    return rows.groupBy("SeqID").agg(F.min(F.struct(order, *rest)).alias("r")).select("SeqID", "r.*")
