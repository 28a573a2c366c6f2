"""The corpus pipeline: quality rules, SimHash near-dedup, decontamination, secret scans, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. The first three drop documents, the fourth masks secrets in texts (and counts n_chars anew), the last
encodes and returns one row of ids for each document left. SQL can't express the stages that hash shingles and merge
bytes, so there is no ORACLE_SQL; tests/llm holds the pipeline against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.llm import bpe, decontam, quality, secrets, simhash
from sporeline.llm.common import shared_dir, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_filter(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens, ids; the ids are decoded again and must give the text's bytes."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = bpe.encode(docs.select("doc_id", "source", "lang", "text"), path, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    checked = F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("decoding does not give the text")))
    return out.select("doc_id", "source", "lang", "n_tokens", checked.alias("ids"))


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("encode", encode_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
