"""FASTA, FASTQ and table files, by Spark's own readers, so any store that Spark reads will do."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sporeline.operators import graph

FASTQ_GLOB = "*.{fastq.gz,fastq,fq.gz,fq}"


def read_fasta(spark: SparkSession, path: str, size_required: bool = False) -> DataFrame:
    """(header, id, size, seq, file): records may run over lines; sequences are upper-cased.

    Lines are split at '>', so large plain files are read in parallel. A header without ';size=' has size null, or is
    an error if one is required.
    """
    raw = spark.read.option("lineSep", ">").text(path).select("value", F.col("_metadata.file_name").alias("file"))
    raw = raw.withColumn("value", F.regexp_replace("value", "\r", "")).filter(F.trim("value") != "")
    header = F.substring_index("value", "\n", 1)
    seq = F.upper(F.regexp_replace(F.expr("substring(value, length(substring_index(value, '\n', 1)) + 1)"), r"\s+", ""))
    size = F.regexp_extract(header, ";size=([0-9]+)", 1).try_cast("long")
    if size_required:
        size = F.coalesce(size, F.raise_error(F.concat(F.lit("no size in header "), header)).cast("long"))
    return raw.select(header.alias("header"), F.regexp_replace(header, ";.*$", "").alias("id"), size.alias("size"), seq.alias("seq"), "file")


#: Splits of one read at most: their states are broadcast, some 100 bytes each. Larger ``spark.sql.files.maxPartitionBytes``
#: makes fewer.
MOST_SPLITS = 1_000_000


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    """(path, first byte, lines) in order; a split comes in several parts."""
    for batch in batches:
        path, start, lines = (batch.column(i).to_pylist() for i in range(3))
        at = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or start[i] != start[at] or path[i] != path[at]:
                yield path[at], start[at], lines[at:i]
                at = i


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split, and 0 to 3 lines of an open record before it: the open lines after it, and the records that begin in it."""
    found: dict[tuple, list] = {}
    for path, start, lines in _by_split(batches):
        states = found.setdefault((path, start), [[s, 0] for s in range(4)])
        blank = [i for i, line in enumerate(lines) if not line]
        for state in states:
            at = 0
            for i in [*blank, len(lines)]:
                state[1] += (state[0] + i - at + 3) // 4 - (state[0] + 3) // 4
                state[0] = (state[0] + i - at) % 4
                if i < len(lines) and state[0]:  # a blank line within a record is part of it
                    state[0] = (state[0] + 1) % 4
                at = i + 1
    kind = pa.list_(pa.list_(pa.int64()))
    rows = [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.int64()), pa.array(list(found.values()), kind)]
    yield pa.RecordBatch.from_arrays(rows, ["path", "start", "steps"])


def _cut(states):
    """Whole records, and of records that go over a split's ends the lines that it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_of, names = states.value, ["path", "record", "line", "lines"]
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.list_(pa.string()))
        rows: list[tuple] = []
        key = None
        record: list[str] = []

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)
            rows.clear()
            return out

        for path, start, lines in _by_split(batches):
            if key != (path, start):
                if record:
                    rows.append((key[0], number, line, record))
                key, record = (path, start), []
                line, begun = open_of[path, start]
                number = begun - (1 if line else 0)
            for text in lines:
                if not record and line == 0 and not text:
                    continue
                record.append(text)
                if line + len(record) == 4:
                    rows.append((path, number, line, record))
                    number, line, record = number + 1, 0, []
                    if len(rows) == 10_000:
                        yield batch()
        if record:
            rows.append((key[0], number, line, record))
        yield batch()

    return run


def read_fastq(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    """(file, SampleID, id, seq, qual, bad, record): four-line records by their number in the file, from 0. Blank lines between
    records are skipped.

    Spark's text reader streams compressed files and splits plain ones anywhere. How many lines of a record are open where a
    split begins follows from the splits before it: each is first read for what it makes of 0, 1, 2 or 3 open lines, and
    these steps are chained for each file. Then each split gives its whole records, and the few that go over its ends are put
    together. bad names what is wrong with a record; strict makes it an error.
    """
    raw = spark.read.text(path).select("_metadata.file_path", "_metadata.file_block_start", "value")
    steps = raw.mapInArrow(_steps, "path string, start long, steps array<array<bigint>>")
    if steps_over(steps := graph.settled(steps), MOST_SPLITS):
        raise ValueError(f"more than {MOST_SPLITS} splits; raise spark.sql.files.maxPartitionBytes")
    chain = F.aggregate(
        F.sort_array(F.collect_list(F.struct("start", "steps"))),
        F.expr("named_struct('open', 0L, 'begun', 0L, 'all', cast(array() as array<struct<start: bigint, open: bigint, begun: bigint>>))"),
        lambda a, x: F.struct(
            F.get(F.get(x["steps"], a["open"].cast("int")), F.lit(0)).alias("open"), (a["begun"] + F.get(F.get(x["steps"], a["open"].cast("int")), F.lit(1))).alias("begun"),
            F.concat(a["all"], F.array(F.struct(x["start"].alias("start"), a["open"].alias("open"), a["begun"].alias("begun")))).alias("all"),
        ),
    )
    chained = steps.groupBy("path").agg(chain["all"].alias("all")).select("path", F.inline("all"))
    states = spark.sparkContext.broadcast({(r.path, r.start): (r.open, r.begun) for r in chained.toLocalIterator()})
    parts = raw.mapInArrow(_cut(states), "path string, record long, line int, lines array<string>")
    whole = parts.filter((F.col("line") == 0) & (F.size("lines") == 4)).select("path", "record", "lines")
    rest = parts.filter((F.col("line") > 0) | (F.size("lines") < 4))
    rest = rest.groupBy("path", "record").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("line", "lines"))), lambda x: x["lines"])).alias("lines"))
    line = lambda i: F.coalesce(F.get("lines", F.lit(i)), F.lit(""))
    bad = (
        F.when(F.size("lines") < 4, "truncated").when(~line(0).startswith("@"), "header").when(~line(2).startswith("+"), "plus")
        .when(F.length(line(1)) != F.length(line(3)), "length")
    )
    out = whole.union(rest).select("path", "record", F.substring_index(F.expr("substring(lines[0], 2)"), " ", 1).alias("id"), line(1).alias("seq"), line(3).alias("qual"), bad.alias("bad"))
    if strict:
        out = out.withColumn("id", F.when(F.col("bad").isNull(), F.col("id")).otherwise(F.raise_error(F.concat(F.lit("bad record: "), "bad"))))
    file = F.url_decode(F.regexp_replace(F.substring_index("path", "/", -1), r"\+", "%2B"))
    return out.select(file.alias("file"), F.regexp_replace(file, r"\.(fastq|fq)(\.gz)?$", "").alias("SampleID"), "id", "seq", "qual", "bad", "record")


def steps_over(rows: DataFrame, most: int) -> bool:
    return rows.limit(most + 1).count() > most


def read_fastq_dir(spark: SparkSession, folder: str) -> DataFrame:
    """All FASTQ files of a folder; none is an error."""
    try:
        return read_fastq(spark, f"{folder.rstrip('/')}/{FASTQ_GLOB}")
    except Exception as e:
        raise FileNotFoundError(f"no FASTQ files in {folder}") from e


def read_pairs(spark: SparkSession, first: str, second: str) -> DataFrame:
    """(id, r1, q1, r2, q2) of two files' reads, joined by id."""
    a = read_fastq(spark, first).select("id", F.col("seq").alias("r1"), F.col("qual").alias("q1"))
    b = read_fastq(spark, second).select("id", F.col("seq").alias("r2"), F.col("qual").alias("q2"))
    return a.join(b, "id")


def sniff(spark: SparkSession, path: str) -> str:
    """'fasta' or 'fastq' by the first character that isn't blank."""
    row = spark.read.text(path).filter(F.trim("value") != "").first()
    first = row.value.strip()[0] if row else ""
    if first not in ">@":
        raise ValueError(f"neither FASTA nor FASTQ: {path}")
    return "fastq" if first == "@" else "fasta"


def read_tsv(spark: SparkSession, path: str, schema: StructType | str, header: bool = False) -> DataFrame:
    """Tab-separated text, gzip or plain, with a declared schema and no quoting."""
    return spark.read.schema(schema).option("sep", "\t").option("quote", "").option("header", header).csv(path)


def read_tolerant(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """As read_tsv; a file that is missing, empty or unreadable gives an empty table of the schema (of a file that breaks off,
    the rows before the break remain)."""
    try:
        return spark.read.schema(schema).option("sep", "\t").option("quote", "").option("ignoreCorruptFiles", True).csv(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All Parquet files below a folder."""
    return spark.read.option("recursiveFileLookup", True).parquet(folder)


def _found(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def read_libraries(spark: SparkSession, folder: str, table: str = "07_SeqTable/Seqs.parquet") -> DataFrame:
    """SRC16: the sequence table of a run's folder, or those of all runs in it, with the column Library: the run's folder, null
    for a single one. Neither is an error."""
    folder = folder.rstrip("/")
    single = _found(spark, f"{folder}/{table}")
    if single is not None:
        return single.withColumn("Library", F.lit(None).cast("string"))
    runs = _found(spark, f"{folder}/*/{table}")
    if runs is None:
        raise FileNotFoundError(f"no {table} in {folder} or its folders")
    # The folder above the table, whether that is a file or a folder of part files.
    place = F.regexp_extract(F.col("_metadata.file_path"), f"([^/]+)/{re.escape(table)}(/[^/]+)?$", 1)
    return runs.withColumn("Library", F.url_decode(place))


def read_barcodes(spark: SparkSession, path: str) -> DataFrame:
    """SRC19: (sample, tag) of a FASTA file of barcodes with any line ends."""
    return read_fasta(spark, path).select(F.col("id").alias("sample"), F.col("seq").alias("tag"))


def read_params(spark: SparkSession, path: str) -> dict[str, str]:
    """SRC18: a table of names and values, tab-separated ('name<tab>value') or as plain YAML ('name: value'), one on a line;
    '#' comments and empty lines are skipped, quotes around a value go. Settings are few, and come to the driver; a later
    line wins."""
    out = {}
    for row in spark.read.text(path, wholetext=True).collect():
        for line in row.value.splitlines():
            name, sep, value = line.partition("\t") if "\t" in line else line.partition(":")
            if line.strip() and not line.lstrip().startswith("#") and sep:
                value = value.strip()
                quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "\"'"
                out[name.strip()] = value[1:-1] if quoted else value
    return out


def write_by_sample(df: DataFrame, path: str, key: str = "SampleID") -> None:
    """Gzipped tab-separated text, a folder for each sample. Tasks write a few samples each; a sample of very many rows is
    written by several tasks under adaptive execution."""
    rows = df.hint("rebalance", key)
    rows.write.partitionBy(key).option("sep", "\t").option("header", True).option("compression", "gzip").option("quote", "").csv(path)


def write_fasta(seqs: DataFrame, path: str) -> None:
    """seqs(id, size, seq) as text records, a part file for each partition, in the partitions' order."""
    seqs.select(F.format_string(">%s;size=%d\n%s", "id", F.col("size").cast("long"), "seq")).write.text(path)


def write_parquet(df: DataFrame, path: str, level: int = 8, rows: int = 0) -> None:
    """Parquet with zstd at a level; ``rows`` bounds the rows of a file."""
    out = df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level)
    (out.option("maxRecordsPerFile", rows) if rows else out).parquet(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.option("sep", "\t").option("header", True).option("compression", "gzip").option("quote", "").csv(path)


def write_uc(pairs: DataFrame, path: str) -> None:
    """pairs(type, query, target) as ten-column UC text."""
    star = F.lit("*")
    pairs.select(F.concat_ws("\t", "type", *[star] * 7, "query", F.coalesce("target", star))).write.text(path)
