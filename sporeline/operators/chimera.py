"""Chimera filters, rescue by occurrence and recovery across runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ("SeqID", "SampleID")


def below_score(rows: DataFrame, most: float, score: str = "DeNovo_Chimera_Score") -> DataFrame:
    """Rows scored under ``most``, and those without a score."""
    return rows.filter((F.col(score) < most) | F.col(score).isNull())


def at_score(rows: DataFrame, most: float, score: str = "DeNovo_Chimera_Score") -> DataFrame:
    return rows.filter(F.col(score) >= most)


def true_chimeras(rows: DataFrame, most: float, score: str = "DeNovo_Chimera_Score") -> DataFrame:
    """Distinct sequences that are putative chimeras wherever they occur."""
    putative = at_score(rows, most, score)
    clean = rows.join(putative.select(*KEY).distinct(), list(KEY), "left_anti")
    return putative.select("Sequence").distinct().join(clean.select("Sequence"), "Sequence", "left_anti")


def recovered(rows: DataFrame, most: float, score: str = "DeNovo_Chimera_Score") -> DataFrame:
    """Distinct putative sequences that also occur in a clean row."""
    putative = at_score(rows, most, score)
    clean = rows.join(putative.select(*KEY).distinct(), list(KEY), "left_anti")
    return putative.select("Sequence").distinct().join(clean.select("Sequence"), "Sequence", "left_semi")


def remove(rows: DataFrame, most: float, recover: bool = True, score: str = "DeNovo_Chimera_Score") -> DataFrame:
    """rows without de novo chimeras; with recovery only those go whose sequence is nowhere clean."""
    if not recover:
        return below_score(rows, most, score)
    return rows.join(true_chimeras(rows, most, score), "Sequence", "left_anti")


def rescue(chimeras: DataFrame, over: int = 2, sequence: str = "Seq") -> DataFrame:
    """Rows of chimeras whose sequence occurs in more than ``over`` rows."""
    often = chimeras.groupBy(sequence).agg(F.count("*").alias("n")).filter(F.col("n") > over)
    return chimeras.join(often.select(sequence), sequence, "left_semi")


def attach_scores(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with DeNovo_Chimera and its score; a row that isn't found is no chimera and has no score."""
    out = rows.join(found.select(*KEY, "DeNovo_Chimera_Score"), list(KEY), "left")
    return out.withColumn("DeNovo_Chimera", F.col("DeNovo_Chimera_Score").isNotNull())
