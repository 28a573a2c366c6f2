"""Incremental ingestion of sequence tables into additive totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def ingest(spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str) -> None:
    """Adds the files that came since the last call: per batch, sums by OTU and sample are written under the batch's
    number, so a batch that is run again replaces its own sums."""

    def put(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy("OTU", "SampleID").agg(F.sum("Abundance").alias("Abundance"))
        sums.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def totals(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).groupBy("OTU", "SampleID").agg(F.sum("Abundance").alias("Abundance"))
