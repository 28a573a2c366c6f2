"""Global row numbers and running sums without one task holding all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sporeline.operators import graph


def running(rows: DataFrame, order: list[Column], size: Column) -> DataFrame:
    """rows with ``before``: the sum of ``size`` over the rows before each in an order without ties.

    Rows are sorted into ranges by the whole order, so neither ties of its first columns nor a common prefix meet in one
    task; the ranges' sums, one row each, are summed before them. The ranges are drawn from a sample, so they are written once.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = graph.settled(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    sums = dealt.groupBy("_part").agg(F.sum(size).alias("_sum"))
    offsets = sums.select("_part", (F.sum("_sum").over(W.orderBy("_part")) - F.col("_sum")).alias("_offset"))
    within = F.sum(size).over(W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)) - size
    return dealt.join(offsets, "_part").withColumn("before", F.col("_offset") + within).drop("_part", "_offset")


def global_rank(rows: DataFrame, order: str) -> DataFrame:
    """rows with rank 1, 2, ... by a column whose values are unique."""
    out = running(rows, [F.col(order)], F.lit(1).cast("long"))
    return out.withColumn("rank", F.col("before") + 1).drop("before")
