"""What the training-text operators share."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word as several operators see it: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors see.

    Where the setting is absent on a single machine (tests), a folder of this machine is set as the checkpoint dir; on a
    cluster its absence is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = sc._jsc.sc().getCheckpointDir()
        if not held.isDefined() and sc.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = held.get() if held.isDefined() else "/tmp/sporeline-checkpoints"
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/sporeline-{uuid.uuid4().hex}"


def finished(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of the partitions ``key=value`` below path that have Spark's mark of a finished write, sorted."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    top = hadoop(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(top)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{key}=") and fs.exists(hadoop(f"{path}/{n}/_SUCCESS")))


def release() -> None:
    """Gives what a worker's finished task held back to the system; workers are used again."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # elsewhere than under glibc it's left to the allocator
        ctypes.CDLL(None).malloc_trim(0)


def batches_of(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``most`` bytes; a longer text is alone."""
    if not batch.num_rows:
        return
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)) // most
    cuts = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def settle(df: DataFrame) -> DataFrame:
    """Cuts the lineage: writes df to the shared folder once and reads it from there."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
