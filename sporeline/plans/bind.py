
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEX, BASES, QUALS = "0123456789abcdef", "ACGTACGTACGTACGT", "+-/13579;=?ACEGI"

#: The same bindings for DuckDB.
DOCS = f"""docs AS (SELECT doc_id, source AS SampleID, sha1(text) AS SeqID, lang,
    translate(sha1(text) || sha1(text || 'k'), '{HEX}', '{BASES}') AS seq, translate(sha1(text), '{HEX}', '{QUALS}') AS qual,
    CASE WHEN lang = 'en' THEN 'Run' || lang || '__' || source ELSE source END AS RunSample, text FROM documents)"""
SCORED = f"""{DOCS}, scored AS (SELECT docs.*, (quality * 3 + toxic * 5) / 10.0::DOUBLE AS score FROM docs LEFT JOIN labels USING (doc_id))"""
CELLS = "cells AS (SELECT l_partkey AS OTU, l_suppkey AS SampleID, CAST(l_quantity AS BIGINT) AS Abundance FROM lineitem)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, SampleID, SeqID, seq, qual, lang, RunSample, text): pseudo-DNA of 80 bases from a text's hashes."""
    d, t = table(spark, sf_dir, "documents"), F.col("text")
    return d.select(
        "doc_id", F.col("source").alias("SampleID"), F.sha1(t).alias("SeqID"),
        F.translate(F.concat(F.sha1(t), F.sha1(F.concat(t, F.lit("k")))), HEX, BASES).alias("seq"),
        F.translate(F.sha1(t), HEX, QUALS).alias("qual"), "lang",
        F.when(F.col("lang") == "en", F.concat(F.lit("Run"), "lang", F.lit("__"), "source")).otherwise(F.col("source")).alias("RunSample"), "text",
    )


def _family(key) -> str:
    return f"translate(concat(sha1(cast({key} div 4 as string)), sha1(concat(cast({key} div 4 as string), 'k'))), '{HEX}', '{BASES}')"


def _family_sql(key) -> str:
    return f"translate(sha1(({key} // 4)::VARCHAR) || sha1(({key} // 4)::VARCHAR || 'k'), '{HEX}', '{BASES}')"


def _mutant(base: str, key: str) -> str:
    """Members of a family of four: the base, one with a base put in, one with a base left out, one with two changes."""
    return f"""CASE {key} % 4 WHEN 0 THEN {base} WHEN 1 THEN concat(substring({base}, 1, 30), 'A', substring({base}, 31, 50))
        WHEN 2 THEN concat(substring({base}, 1, 50), substring({base}, 52, 29)) ELSE concat(substring({base}, 1, 9), 'C', substring({base}, 11, 59), 'T', substring({base}, 71, 10)) END"""


#: Whole sequences of some 80 bases with near copies: documents in families of four by id, each the heavier the lower.
FAMILIES = f"families AS (SELECT doc_id, source AS SampleID, {_mutant(_family_sql('doc_id'), 'doc_id')} AS seq, (CASE doc_id % 4 WHEN 0 THEN 40 WHEN 1 THEN 3 ELSE 1 END)::BIGINT AS size FROM documents)"


def families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, SampleID, seq, size), as FAMILIES."""
    size = F.expr("CASE doc_id % 4 WHEN 0 THEN 40L WHEN 1 THEN 3L ELSE 1L END")
    return table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("SampleID"), F.expr(_mutant(_family("doc_id"), "doc_id")).alias("seq"), size.alias("size"))


def otu_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(OTU, seq): parts in families of four by key."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("OTU"), F.expr(_mutant(_family("p_partkey"), "p_partkey")).alias("seq"))


OTU_SEQS = f"otus AS (SELECT p_partkey AS OTU, {_mutant(_family_sql('p_partkey'), 'p_partkey')} AS seq FROM part)"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """docs with a score from the labels; null where there is none."""
    labels = table(spark, sf_dir, "labels")
    return docs(spark, sf_dir).join(labels, "doc_id", "left").withColumn("score", (F.col("quality") * 3 + F.col("toxic") * 5) / F.lit(10.0)).drop("quality", "toxic")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(OTU, SampleID, Abundance) from order lines."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("OTU"), F.col("l_suppkey").alias("SampleID"), F.col("l_quantity").cast("long").alias("Abundance"))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, start, end): events of a user as intervals in minutes."""
    e = table(spark, sf_dir, "events")
    start = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 60).cast("long")
    return e.select(F.col("user_id").alias("id"), start.alias("start"), (start + F.floor("value").cast("long")).alias("end"))


HITS = """hits AS (SELECT user_id AS id, floor(epoch(ts) / 60)::BIGINT AS "start", (floor(epoch(ts) / 60)::BIGINT + floor("value"))::BIGINT AS "end" FROM events)"""
