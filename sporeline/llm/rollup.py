"""Token counts as delta-maintained rollups.

A batch of changes is signed: an insert adds a document's counts, a delete takes them away, a revision is a delete of the
old counts and an insert of the new. Only additive totals are kept, by source, language and tokenizer version, so
a batch is one aggregate over its changes and is merged by addition. Every batch has an id and is committed once: its
totals are written as a partition of that id, and a batch whose partition is there is not added again, so a retried or
repeated commit changes nothing; compaction carries the ids over. A rollup has one writer at a time: two commits of one
id at the same moment are not told apart.

Tokenizer versions are vocabulary files: rank files are counted by byte_bpe's merges, JSON files by the tokenizers
library. Each text is counted once for each, and a task adds its texts up by source and language before the shuffle.

Defined cases: a null text counts as an empty text; a null source or language is a group of its own; repeated rows are
documents of their own; an empty batch commits nothing; totals that come to no documents are dropped; extra columns are
ignored; very long texts are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.llm import bpe, tokenfile
from sporeline.llm.common import batches_of, finished, shared_dir, table

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens", "n_bytes")
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_bytes long"


@dataclass(frozen=True)
class Version:
    """A tokenizer version: its name, the bytes of its file, and for a rank file the pattern that cuts texts."""

    name: str
    content: bytes
    pattern: str | None = None

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text, without special tokens; a worker makes its tokenizer once."""
        if self.pattern is None:
            return tokenfile._encoder(self.content.decode()).counts(texts)
        own = bpe.vocabulary(self.content, self.pattern)
        out = [own.encode_batch(b.column(0))[1] for b in batches_of(pa.RecordBatch.from_arrays([texts], ["text"]), 0, bpe.BATCH_BYTES)]
        return np.concatenate([np.zeros(0, np.int64), *out])


def versions(names: tuple = ("byte_bpe_50k.tiktoken", "word_bpe_49k.json")) -> list[Version]:
    """Versions by the names of public vocabulary files."""
    import public_tokenizers

    out = []
    for n in names:
        with open(public_tokenizers.path(n), "rb") as f:
            out.append(Version(n.split(".")[0], f.read(), public_tokenizers.PATTERN if n.endswith(".tiktoken") else None))
    return out


def counted(docs: DataFrame, sign: int | Column = 1, tokenizers: list[Version] | None = None) -> DataFrame:
    """Signed sums (KEYS, SUMS) of docs(text, source, lang): a row for each source, language and version of a task."""
    sent = docs.sparkSession.sparkContext.broadcast(versions() if tokenizers is None else tokenizers)
    s = F.lit(sign) if isinstance(sign, int) else sign

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for whole in batches:
            for b in batches_of(whole, 2, tokenfile.BATCH_BYTES):
                signs = b.column(3).to_numpy()
                size = pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy()
                groups: dict[tuple, list[int]] = {}
                for i, key in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                    groups.setdefault(key, []).append(i)
                for v in sent.value:
                    n = v.counts(b.column(2))
                    for key, at in groups.items():
                        own = np.array([signs[at].sum(), (signs[at] * n[at]).sum(), (signs[at] * size[at]).sum()], np.int64)
                        sums[*key, v.name] = sums.get((*key, v.name), 0) + own
            if len(sums) > 100_000:
                yield _rows(sums)
                sums = {}
        yield _rows(sums)

    rows = docs.select(F.col("source").cast("string"), F.col("lang").cast("string"), F.col("text"), s.cast("long").alias("s"))
    return rows.mapInArrow(run, SCHEMA)


def _rows(sums: dict) -> pa.RecordBatch:
    keys = [pa.array([k[i] for k in sums], pa.string()) for i in range(3)]
    return pa.RecordBatch.from_arrays([*keys, *(pa.array([int(v[i]) for v in sums.values()], pa.int64()) for i in range(3))], [*KEYS, *SUMS])


def revised(old: DataFrame, new: DataFrame, tokenizers: list[Version] | None = None) -> DataFrame:
    """The signed sums of a revision: old versions out, new versions in."""
    parts = [x.select("text", "source", "lang", F.lit(s).alias("sign")) for x, s in ((old, -1), (new, 1))]
    return counted(parts[0].unionByName(parts[1]), F.col("sign"), tokenizers)


@dataclass(frozen=True)
class Rollup:
    """Totals in a folder that all executors share: one partition of sums for each committed batch."""

    spark: SparkSession
    path: str

    def batches(self) -> list[str]:
        """Ids of committed batches. A batch is there once its partition has Spark's mark of a finished write."""
        return finished(self.spark, self.path, "batch")

    def covered(self) -> set[str]:
        """Ids of the batches that went into compacted ones; one row for each batch."""
        parts = [f"{self.path}/of={b}" for b in finished(self.spark, self.path, "of")]
        return {r.id for r in self.spark.read.schema("id string").parquet(*parts).collect()} if parts else set()

    def commit(self, batch: str, signed: DataFrame) -> bool:
        """Adds a batch's signed rows; False if it had been committed before. What an unfinished commit left is replaced."""
        if batch in self.batches() or batch in self.covered():
            return False
        sums = signed.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        sums.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        """(KEYS, SUMS) over all committed batches. A group's rows are one for each batch at most."""
        done = self.batches()
        if not done:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/batch={b}" for b in done])
        return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).filter("n_docs <> 0")

    def compact(self, batch: str) -> "Rollup":
        """A rollup elsewhere with all totals as one batch; ids committed here stay committed there."""
        other = Rollup(self.spark, shared_dir(self.spark))
        ids = sorted({*self.batches(), *self.covered()})
        self.spark.createDataFrame([(i,) for i in ids], "id string").coalesce(1).write.parquet(f"{other.path}/of={batch}")
        self.totals().write.parquet(f"{other.path}/batch={batch}")
        return other


def op6_token_rollup(spark, sf_dir):
    """All documents are inserted; then those whose id leaves 3 when divided by 20 are revised to have their text twice,
    and those of language 'es' deleted; both later batches are committed twice."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = Rollup(spark, shared_dir(spark))
    out.commit("0-all", counted(docs))
    changed = F.col("doc_id") % 20 == 3
    old = docs.filter(changed)
    twice = F.concat_ws(" ", "text", "text")
    current = docs.filter("lang = 'es'").withColumn("text", F.when(changed, twice).otherwise(F.col("text")))
    for _ in range(2):
        out.commit("1-revised", revised(old, old.withColumn("text", twice)))
        out.commit("2-deleted", counted(current, -1))
    return out.totals()


QUERIES, ORACLES = {"op6_token_rollup": op6_token_rollup}, {}
