"""Per-sample and per-run summaries from count tables."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def basis_points(part: Column, whole: Column, empty: int = 10_000) -> Column:
    """Share in hundredths of a percent; ``empty`` where there is nothing to share."""
    return F.when(whole == 0, F.lit(empty).cast("long")).otherwise(F.floor(10_000 * part / whole).cast("long"))


def fold(tables: dict[str, DataFrame], key: str = "file") -> DataFrame:
    """The full outer join of count tables (key, n), one column for each, 0 where a table lacks the key.

    All tables are hashed by the one key, so each is shuffled once.
    """
    named = [t.select(key, F.col("n").alias(name)) for name, t in tables.items()]
    out = functools.reduce(lambda a, b: a.join(b, key, "full"), named)
    return out.fillna(0, list(tables))


def per_run(samples: DataFrame, columns: list[str], whole: str) -> DataFrame:
    """One row: totals of the columns and their share of ``whole``."""
    out = samples.agg(F.count("*").alias("n_samples"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
    return out.withColumns({f"{c}_bp": basis_points(F.col(c), F.col(whole)) for c in columns if c != whole})


def targets(uc: DataFrame) -> DataFrame:
    """(SampleID, n_queries, n_targets) of hits(SampleID, Query, Target)."""
    return uc.groupBy("SampleID").agg(F.count("*").alias("n_queries"), F.count_distinct("Target").alias("n_targets"))


def sample_totals(rows: DataFrame, jump: str = "TagJump") -> DataFrame:
    """(SampleID, reads, rows, tj_reads, tj_rows)."""
    return rows.groupBy("SampleID").agg(
        F.sum("Abundance").alias("reads"), F.count("*").alias("rows"),
        F.coalesce(F.sum(F.when(F.col(jump), F.col("Abundance"))), F.lit(0)).alias("tj_reads"), F.count_if(F.col(jump)).alias("tj_rows"),
    )


def reorder(df: DataFrame, first: list[str]) -> DataFrame:
    """The named columns that are there, then the rest."""
    return df.select([c for c in first if c in df.columns] + [c for c in df.columns if c not in first])


def sample_name(file: Column) -> Column:
    """A file's name without the suffixes that stages add."""
    base = F.regexp_replace(file, r"^.*/", "")
    return F.regexp_replace(F.regexp_replace(base, r"\.(gz|zst)$", ""), r"(_(PrimerChecked|NoChimera|Chimera|hpc|uc))?\.(fastq|fq|fasta|fa|txt)$", "")
