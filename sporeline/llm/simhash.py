"""SimHash near-duplicates, candidates by pigeonring filtering.

A fingerprint is four segments of 16 bits on a ring. If two differ in at most 3 bits, then from some segment on every
chain of l consecutive segments differs in at most floor(3 * l / 4) bits: none in the first, 1 in two, 2 in three. The
first two bounds make the join key: a fingerprint is filed under each pair of consecutive segments, and looks there
under its own pair and those with one bit of the second segment turned. So a key has 32 bits, where the pigeonhole
principle alone gives 16. The chain of three and the whole distance are checked in the join.

Copies of one fingerprint are a single row throughout (a representative and membership), however many there are.

Defined cases: a null or wordless text has fingerprint zero, linked like any other; a null doc_id is never a
component's id where another is there; repeated rows are equal members; ``keep_one`` tells components apart by their
fingerprints, so texts that share an id, or have none, stay if they differ; an empty table gives an empty result; extra columns stay in
``keep_one``, whatever their names; very long texts are signed in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sporeline.llm.common import batches_of, release, settle, table
from sporeline.llm.components import roots

#: Shingles whose bits are summed at once; a very long text is handled in several such parts.
PART = 65_536
#: Bytes of texts that are signed at once, about.
BATCH_BYTES = 2_000_000


def fingerprint(text: str | None, width: int = 3) -> int:
    """64 bits: each is 1 if set in over half of the XXH64 hashes (seed 42) of the text's word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width)))) if len(words) >= width else iter([b" ".join(words)])
    digest = xxhash.xxh64_digest
    raw = np.frombuffer(b"".join([digest(s, 42) for s in shingles]), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, PART):
        ones += np.unpackbits(raw[at : at + PART], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in batches_of(whole, 1, BATCH_BYTES):
            fp = pa.array([fingerprint(t) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], ["doc_id", "fp"])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _signed(batches)
    release()  # after the last batch is let go; idle workers stay beside later stages


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the 64 bits of each text as a signed long."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_sign, "doc_id long, fp long")


def _segment(fp: str, k: str) -> str:
    return f"(shiftrightunsigned({fp}, 48 - 16 * (({k}) % 4)) & 65535L)"


def links(prints: DataFrame) -> DataFrame:
    """(u, v), u > v: all pairs of the distinct fingerprints prints(fp) that differ in 1 to 3 bits."""
    starts = prints.select("fp", F.expr("explode(sequence(0, 3))").alias("k"))
    pair = f"(shiftleft({_segment('fp', 'k')}, 16) | {_segment('fp', 'k + 1')})"
    filed = starts.select(F.col("fp").alias("v"), F.col("k").alias("k1"), F.expr(pair).alias("key1"))
    turned = f"transform(sequence(-1, 15), j -> if(j < 0, {pair}, {pair} ^ shiftleft(1L, greatest(j, 0))))"
    looked = starts.select(F.col("fp").alias("u"), "k", F.explode(F.expr(turned)).alias("key"))
    chain = "bit_count(" + " | ".join(f"shiftleft({_segment('(u ^ v)', f'k + {i}')}, {16 * i})" for i in range(3)) + ") <= 2"
    on = (F.col("k") == F.col("k1")) & (F.col("key") == F.col("key1")) & (F.col("u") > F.col("v"))
    on = on & F.expr(chain) & F.expr("bit_count(u ^ v) <= 3")
    return looked.join(filed.hint("shuffle_hash"), on).select("u", "v").distinct()


@F.arrow_udf(T.LongType())
def _print(texts: pa.Array) -> pa.Array:
    return pa.array([fingerprint(t.as_py()) for t in texts], pa.int64())  # one text at a time


def group(signed: DataFrame) -> DataFrame:
    """signed(doc_id, fp), settled, with component_id, the smallest doc_id that links reach, and root, its least fp."""
    prints = settle(signed.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = roots(links(prints.select("fp")))
    # Only fingerprints with a link need more than their own smallest id.
    linked = prints.join(found.withColumnRenamed("node", "fp"), "fp")
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    of = linked.join(ids, "root").select("fp", "root", "component_id")
    own = F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id"))
    of = settle(prints.join(of, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), own.alias("component_id")))
    # A fingerprint with very many copies is a skewed key here; Spark splits it, as this join is followed by nothing.
    return signed.join(of, "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, root, component_id) for each row of docs(doc_id, text)."""
    return group(settle(signatures(docs)))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without all but one row of each component: the one with the smallest doc_id, then fingerprint.

    Ids name the rows to keep where no id is repeated. Otherwise the texts are signed again, as only id and fingerprint
    together tell which component a row is of. Both ways keep the same rows; the first signs each text once.
    """
    signed = settle(signatures(docs))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("m")
    kept = settle(group(signed).groupBy("root").agg(first).select(F.col("m.doc_id").alias("id"), F.col("m.fp").alias("fp")))
    # A struct, so that no column's name can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"))
    same = F.col("own.doc_id").eqNullSafe(F.col("id"))
    if signed.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return rows.join(kept.select("id"), same, "left_semi").select("own.*")
    found = rows.withColumn("print", _print("own.text")).join(kept, (F.col("print") == F.col("fp")) & same, "left_semi")
    return found.groupBy(F.col("own.doc_id").alias("id"), "print").agg(F.first("own").alias("own")).select("own.*")


def op8_simhash_near_dedup(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES, ORACLES = {"op8_simhash_near_dedup": op8_simhash_near_dedup}, {}
