"""Token ids in ORC files, in the order of document ids.

Documents are dealt by ranges of doc_id (a shuffle of the texts; the ranges come from a sample of the ids and only set
the files' sizes, their number comes from the texts' bytes), sorted within a range, encoded there and written: one file
per range, so the files in order hold all ids in ascending order. ORC stores the ids with integer run-length encoding, with row indexes and a Bloom filter on
doc_id, so a reader takes stripes in parallel and skips those that can't hold a wanted document.

Defined cases: a null text is an empty text, whose only id is the end id; a null doc_id comes first; rows with one
doc_id lie side by side in the order of their texts; an empty table gives no rows; very long texts are one row each;
columns other than doc_id and text aren't written.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sporeline.llm.common import batches_of, settle, shared_dir, table

#: Words in a generation of a worker's memory, which holds two; at about 40 bytes each, 50 MB while they are looked up.
REMEMBERED = 600_000
#: Bytes of texts for which there is a file, about; there are as many files as shuffle partitions at least.
FILE_BYTES = 32_000_000
#: Bytes of texts encoded at once, about.
BATCH_BYTES = 16_000_000
SCHEMA = "doc_id long, place long, ids array<int>"


class _Ragged:
    """Arrays of ids, one for each number, in one array that grows by doubling."""

    def __init__(self):
        self.ends, self.ids, self.n = np.zeros(1_024, np.int64), np.zeros(4_096, np.int32), 0

    def lengths(self, at: np.ndarray) -> np.ndarray:
        return self.ends[at + 1] - self.ends[at]

    def take(self, at: np.ndarray) -> np.ndarray:
        """The ids of the numbers, one array after the other."""
        n = self.lengths(at)
        out = np.repeat((self.ends[at] - np.cumsum(n) + n).astype(np.int32), n)
        out += np.arange(len(out), dtype=np.int32)
        return self.ids[out]

    def add(self, lengths: np.ndarray, ids: np.ndarray) -> None:
        m, old = self.n + len(lengths), int(self.ends[self.n])
        while len(self.ends) <= m:
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while len(self.ids) < old + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ends[self.n + 1 : m + 1] = old + np.cumsum(lengths)
        self.ids[old : old + len(ids)] = ids
        self.n = m


class WordEncoder:
    """A tokenizer of the tokenizers library whose pieces never reach over white space, with its words remembered.

    Words are numbered; a text is its words' numbers, whose ids are gathered for a whole batch at once. When a
    generation of words is full it becomes the one before, from which words in use are carried over.
    """

    def __init__(self, spec: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.own, self.remembered = Tokenizer.from_str(spec), remembered
        suffix = self.own.model.end_of_word_suffix
        vocab = self.own.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.marks: dict[str, list[int]] = {}
        self.known = self.before = pa.array([], pa.string())
        self.pieces, self.old = _Ragged(), _Ragged()

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [x.ids for x in self.own.encode_batch_fast(words, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[list[int]]:
        """Words of letters, many in a text. Each is one piece or more and a piece ends in one id that says so, so if
        there are as many ends as words, each word is what lies between two ends."""
        out = []
        chunks = [words[i : i + 200] for i in range(0, len(words), 200)]
        for chunk, ids in zip(chunks, self._encode([" ".join(c) for c in chunks])):
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(chunk) or ends[-1] != len(ids):
                out += self._encode(chunk)
            else:
                at = [0, *ends.tolist()]
                out += [ids[a:b] for a, b in zip(at, at[1:])]
        return out

    def _learn(self, words: list[str]) -> list[list[int]]:
        """Marks after a letter are a piece by themselves, so a word of letters and marks is put together from two parts."""
        cut = [m.groups() if (m := _marked(w)) else (w, "") for w in words]
        heads = list(dict.fromkeys(h for h, _ in cut))
        letters = [h for h in heads if h.isalpha()]
        other = [h for h in heads if not h.isalpha()]
        of = dict(zip(letters, self._letters(letters)))
        of.update(zip(other, self._encode(other)))
        if len(self.marks) > 10_000:
            self.marks.clear()
        tails = list({t for _, t in cut}.difference(self.marks))
        self.marks.update(zip(tails, self._encode(tails)))
        return [of[h] + self.marks[t] if t else of[h] for h, t in cut]

    def _add(self, words: pa.Array) -> None:
        """Numbers words that this generation lacks: those of the one before are carried over, others are learnt."""
        at = _places(words, self.before)
        learnt = self._learn(words.filter(pa.array(at < 0)).to_pylist())
        lengths = np.zeros(len(at), np.int64)
        lengths[at >= 0] = self.old.lengths(at[at >= 0])
        lengths[at < 0] = np.fromiter(map(len, learnt), np.int64, len(learnt))
        ids = np.zeros(int(lengths.sum()), np.int32)
        was = np.repeat(at >= 0, lengths)
        ids[was] = self.old.take(at[at >= 0])
        ids[~was] = np.fromiter(itertools.chain.from_iterable(learnt), np.int32, len(ids) - int(was.sum()))
        self.pieces.add(lengths, ids)
        self.known = pa.concat_arrays([self.known, words])

    def _numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all words, ends of the texts in them); every number has its ids. All but _learn runs in Arrow."""
        if len(self.known) > self.remembered:
            self.before, self.old, self.known, self.pieces = self.known, self.pieces, self.known[:0], _Ragged()
        texts = pc.fill_null(texts, "")
        # The tokenizer composes letters and marks before it lowers them, which for a few is not the same.
        if not pc.any(pc.match_substring_regex(texts, "[\u0300-\u036f]"), min_count=0).as_py():
            texts = pc.ascii_lower(texts)
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary
        at = _places(distinct, self.known)
        if (new := np.flatnonzero(at < 0)).size:
            at[new] = len(self.known) + np.arange(len(new))
            self._add(distinct.take(pa.array(new)))
        return at[coded.indices.to_numpy()], np.cumsum(pc.list_value_length(words).to_numpy())

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Ids in each text."""
        at, ends = self._numbers(texts)
        sums = np.concatenate([[0], np.cumsum(self.pieces.lengths(at))])
        return np.diff(sums[ends], prepend=0)

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids in each); null is an empty text."""
        at, ends = self._numbers(texts)
        sums = np.concatenate([[0], np.cumsum(self.pieces.lengths(at))])
        return self.pieces.take(at), np.diff(sums[ends], prepend=0)


def _places(words: pa.Array, of: pa.Array) -> np.ndarray:
    """Where each word stands in ``of``; -1 for those that don't."""
    return pc.fill_null(pc.index_in(words, of), -1).to_numpy().astype(np.int64)


_marked = re.compile(r"([A-Za-z]+)([!-&(-/:-@\[-`{-~]+)").fullmatch


_held: dict[int, WordEncoder] = {}


def _encoder(spec: str) -> WordEncoder:
    key = hash(spec)
    if key not in _held:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _held[key] = WordEncoder(spec)
    return _held[key]


def write(docs: DataFrame, spec: str, path: str, end_id: int, stride: int = 1_000) -> None:
    """Writes docs(doc_id, text) to ORC files below path. spec: the tokenizer's JSON, as text."""
    held = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, place = _encoder(held.value), 0
        for whole in batches:
            for b in batches_of(whole, 1, BATCH_BYTES):
                ids, n = own.encode_batch(b.column(1))
                ends = np.cumsum(n)
                ids = np.insert(ids, ends, end_id)  # after each document
                at = pa.array(np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]), pa.int32())
                lists = pa.ListArray.from_arrays(at, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.arange(place, place + len(n))), lists], ["doc_id", "place", "ids"])
                place += len(n)

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    files = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // FILE_BYTES))
    ranged = rows.repartitionByRange(files, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    (
        ranged.mapInArrow(run, SCHEMA)
        .write.option("compression", "zstd")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", stride)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc_id, place, ids) of the files below path; the order is (first doc_id of the file, place)."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows.select(F.col("_metadata.file_name").alias("file"), "doc_id", "place", "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents: the ids are pushed down to the files' statistics, row indexes and Bloom filters, so
    stripes and groups of rows that can't hold them aren't read."""
    return read(spark, path).filter(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column(3)
        at = ids.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<i4")).cast("B")
        crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(at.tolist(), at[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
            ["file", "doc_id", "place", "n_tokens", "ids_crc32"],
        )


def layout(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files.

    A file's rows are numbered by a running sum within it (a file is bounded); the files' totals, one row each, are
    summed in order and joined.
    """
    rows = settle(read(spark, path).mapInArrow(_sums, "file string, doc_id long, place long, n_tokens long, ids_crc32 long"))
    rows = rows.withColumn("within", F.sum("n_tokens").over(W.partitionBy("file").orderBy("place")) - F.col("n_tokens"))
    files = rows.groupBy("file").agg(F.min("doc_id").alias("first"), F.sum("n_tokens").alias("total"))
    before = files.withColumn("before", F.sum("total").over(W.orderBy(F.col("first").asc_nulls_first())) - F.col("total"))
    return rows.join(before.select("file", "before"), "file").select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def op7_token_files(spark, sf_dir):
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    path = shared_dir(spark)
    write(table(spark, sf_dir, "documents"), spec, path, 2)
    return layout(spark, path)


QUERIES, ORACLES = {"op7_token_files": op7_token_files}, {}
