"""Membership maps (query -> target) and their composition over clustering stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_target(uc: DataFrame) -> DataFrame:
    """One target, the least, for each query. An aggregate with partial sums; no sort."""
    return uc.groupBy("query").agg(F.min("target").alias("target"))


def _named(uc: DataFrame, query: str, target: str) -> DataFrame:
    return best_target(uc).select(F.col("query").alias(query), F.col("target").alias(target))


def compose(derep: DataFrame, clust: DataFrame, preclust: DataFrame | None = None) -> DataFrame:
    """(SeqID, DerepID, [PreclusterID,] OTU): left joins, so unmapped members keep a null OTU."""
    out = _named(derep, "SeqID", "DerepID")
    if preclust is None:
        return out.join(_named(clust, "DerepID", "OTU"), "DerepID", "left").select("SeqID", "DerepID", "OTU")
    out = out.join(_named(preclust, "DerepID", "PreclusterID"), "DerepID", "left")
    out = out.join(_named(clust, "PreclusterID", "OTU"), "PreclusterID", "left")
    return out.select("SeqID", "DerepID", "PreclusterID", "OTU")


def merge_nullable(derep: DataFrame, clust: DataFrame) -> DataFrame:
    """(SeqID, OTU) by two maps that may lack members."""
    return compose(derep, clust).select("SeqID", "OTU")


def parse_uc(lines: DataFrame, map_only: bool = True, split_id: bool = True, unique: bool = True) -> DataFrame:
    """(type, query, target) of UC text lines(value): hits and seeds; annotations after ';' go, repeats go."""
    c = F.split("value", "\t")
    rows = lines.select(c[0].alias("type"), c[8].alias("query"), c[9].alias("target")).filter(F.col("type").isin("H", "S"))
    rows = rows.withColumn("target", F.when(F.col("type") == "S", F.col("query")).otherwise(F.col("target")))
    if split_id:
        rows = rows.withColumns({k: F.split_part(F.col(k), F.lit(";"), F.lit(1)) for k in ("query", "target")})
    if map_only:
        rows = rows.select("query", "target")
    return rows.distinct() if unique else rows
