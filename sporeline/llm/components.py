"""Connected components of a link table, by alternating large-star and small-star rounds.

Links stay distributed: a round joins each link to its end's least neighbour, and writes the new links to the shared
folder, so lineage stays short and a lost executor costs one round's tasks. Rounds number about the logarithm of the
longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.llm.common import settle


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links(u, v), u > v. Large: u's larger neighbours, small: u and its smaller ones, are linked to u's least."""
    if large:
        near = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = links
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    far = near.join(least, "u")
    out = far.filter("v > u").select(F.col("v").alias("u"), "m") if large else far.select(F.col("v").alias("u"), "m").union(least)
    return out.select("u", F.col("m").alias("v")).filter("u > v").distinct()


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links(u, v): root is the least node of its component. Both ends have one type.

    Self-links and repeated links are allowed; an empty table gives an empty result.
    """
    now = settle(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct())
    mark = lambda x: x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    before = mark(now)
    while before[0]:
        now = settle(_star(_star(now, True), False))
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
