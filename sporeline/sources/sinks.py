"""Tables as other tools want them: wide and sparse matrices, tables with a key, versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.operators import graph, otu, relational
from sporeline.operators.ranks import global_rank

#: Cells of a wide file, and its columns at most.
CELLS, SAMPLES = 50_000_000, 5_000


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC9: comma-separated text without a header, with a declared schema."""
    return spark.read.schema(schema).option("header", False).csv(path)


def write_wide(long: DataFrame, path: str, cells: int = CELLS, samples: int = SAMPLES) -> list[str]:
    """SNK7: long(OTU, SampleID, Abundance) as gzipped tab-separated text, OTUs in falling order of their total. Samples go to
    folders of at most ``samples`` columns, and a folder's files have at most ``cells`` cells; the folders are returned. A
    sample is a column, so their names come to the driver."""
    long = graph.settled(long.select("OTU", "SampleID", "Abundance"))
    totals = long.groupBy("OTU").agg(F.sum("Abundance").alias("_total"))
    names = otu.sample_names(long)
    out = []
    for i in range(0, len(names), samples):
        some = names[i : i + samples]
        own = F.col("SampleID").isin([s for s in some if s is not None]) | (F.col("SampleID").isNull() if None in some else F.lit(False))
        wide = otu.wide_table(long.filter(own), some)
        # OTUs of other folders' samples alone have a row of zeros, so that folders fit together.
        rows = totals.join(wide, "OTU", "left").na.fill(0).orderBy(F.desc("_total"), "OTU").drop("_total")
        out.append(f"{path.rstrip('/')}/samples-{i // samples:03d}")
        writer = rows.write.option("sep", "\t").option("header", True).option("compression", "gzip").option("quote", "")
        writer.option("maxRecordsPerFile", max(1, cells // (len(some) + 1))).csv(out[-1])
    return out


def require_dense(long: DataFrame, cells: int = CELLS) -> DataFrame:
    """SNK8: long, or an error if its dense matrix had more than so many cells."""
    n, m = long.agg(F.count_distinct("OTU"), F.count_distinct("SampleID")).first()
    if n * m > cells:
        raise ValueError(f"{n} OTUs by {m} samples are over {cells} cells; use write_sparse")
    return long


def write_sparse(long: DataFrame, path: str) -> None:
    """SNK8: long as a sparse matrix in coordinate text: folders rows and columns (number, name) and matrix, whose part files,
    one after another, are a file in the exchange format that R and SciPy read. Rows of one cell are added up."""
    own = graph.settled(long.groupBy("OTU", "SampleID").agg(F.sum("Abundance").alias("n")).filter("n <> 0 and OTU is not null and SampleID is not null"))
    rows = graph.settled(global_rank(own.select("OTU").distinct(), "OTU"))
    columns = graph.settled(global_rank(own.select("SampleID").distinct(), "SampleID"))
    sizes = [rows.count(), columns.count(), own.count()]
    for table, name in ((rows.select("rank", "OTU"), "rows"), (columns.select("rank", "SampleID"), "columns")):
        table.orderBy("rank").write.option("sep", "\t").option("quote", "").csv(f"{path}/{name}")
    cells = own.join(rows.withColumnRenamed("rank", "i"), "OTU").join(columns.withColumnRenamed("rank", "j"), "SampleID")
    head = long.sparkSession.createDataFrame([("%%MatrixMarket matrix coordinate integer general\n" + " ".join(map(str, sizes)),)], "value string").coalesce(1)
    head.union(cells.select(F.concat_ws(" ", "i", "j", "n").alias("value"))).write.text(f"{path}/matrix")


def write_keyed(rows: DataFrame, table: str, key: str) -> None:
    """SNK10: a managed table in place of one of that name, once its key is unique and never null."""
    relational.require_unique(graph.settled(rows), key).write.mode("overwrite").saveAsTable(table)


def write_versions(versions: DataFrame, path: str) -> None:
    """C11: versions(process, tool, version) of all tasks, each once, as sorted YAML text in one file: tools are few."""
    lines = versions.distinct().groupBy("process").agg(F.array_sort(F.collect_set(F.struct("tool", "version"))).alias("v")).orderBy("process")
    text = F.concat(F.lit('"'), "process", F.lit('":\n'), F.array_join(F.transform("v", lambda x: F.concat(F.lit("    "), x["tool"], F.lit(": "), x["version"])), "\n"))
    lines.select(text.alias("value")).coalesce(1).write.text(path)
