"""SRC4: BAM files of reads as a data source that is read in splits.

A file is a row of compressed blocks, whose ends don't fall on records'. A split takes the records whose first byte stands
in a block that begins in the split, and reads on to the end of the last. It finds its first block by the mark of a block,
followed by another one where that says; and its first record as the first place from which lengths, name and references
are those of a record and of CHAIN more after it. Files are opened through pyarrow, so other stores than local ones work as
far as that knows them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, id string, flag int, seq string, qual string"
#: Fixed values of the format: a block's first bytes, the letters of 4-bit codes, bits of flags.
MARK, CODES = b"\x1f\x8b\x08\x04", "=ACMGRSVTWYHKDBN"
REVERSE, NOT_PRIMARY = 0x10, 0x900
#: Records that must follow the first one of a split; the largest header of a block.
CHAIN, HEADER = 4, 4096
_PAIRS = [a + b for a in CODES for b in CODES]
_TURN = str.maketrans("ACMGRSVTWYHKDBN", "TGKCYSBAWRDMHVN")


class _Blocks:
    """The blocks of a file from a place on, inflated one after another."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def header(self, at: int) -> tuple[int, int] | None:
        """(bytes of the block, bytes before its data) at a place, if there is a block."""
        self.file.seek(at)
        head = self.file.read(min(HEADER, self.size - at))
        if len(head) < 18 or head[:4] != MARK:
            return None
        extra = struct.unpack_from("<H", head, 10)[0]
        i = 12
        while i + 4 <= min(12 + extra, len(head) - 2):
            length = struct.unpack_from("<H", head, i + 2)[0]
            if head[i : i + 2] == b"BC" and length == 2:
                return struct.unpack_from("<H", head, i + 4)[0] + 1, 12 + extra
            i += 4 + length
        return None

    def first(self, at: int) -> int:
        """The first place from ``at`` on where a block begins."""
        while at < self.size:
            self.file.seek(at)
            data = self.file.read(1 << 17)
            i = data.find(MARK)
            while i >= 0:
                found = self.header(at + i)
                if found and (at + i + found[0] == self.size or at + i + found[0] < self.size and self.header(at + i + found[0])):
                    return at + i
                i = data.find(MARK, i + 1)
            at += max(1, len(data) - len(MARK) + 1)
        return self.size

    def data(self, at: int) -> Iterator[tuple[int, bytes]]:
        while at < self.size:
            found = self.header(at)
            if not found:
                raise ValueError(f"no block at byte {at}")
            size, before = found
            self.file.seek(at + before)
            yield at, zlib.decompress(self.file.read(size - before - 8), -15)
            at += size


class _Stream:
    """What blocks hold, as one buffer; ``block(at)`` is where the block begins that has a byte."""

    def __init__(self, blocks: Iterator[tuple[int, bytes]]):
        self.blocks, self.buffer, self.base, self.marks = blocks, bytearray(), 0, []

    def has(self, upto: int) -> bool:
        while self.base + len(self.buffer) < upto:
            new = next(self.blocks, None)
            if new is None:
                return False
            self.marks.append((self.base + len(self.buffer), new[0]))
            self.buffer += new[1]
        return True

    def get(self, at: int, n: int) -> bytes:
        if not self.has(at + n):
            raise ValueError("the file breaks off")
        return bytes(self.buffer[at - self.base : at - self.base + n])

    def block(self, at: int) -> int:
        while len(self.marks) > 1 and self.marks[1][0] <= at:
            self.marks.pop(0)
        return self.marks[0][1]

    def drop(self, upto: int) -> None:
        if upto - self.base > 1 << 20:
            del self.buffer[: upto - self.base]
            self.base = upto


def _header_end(stream: _Stream) -> tuple[int, int]:
    """(place after the header, number of references)."""
    if stream.get(0, 4) != b"BAM\1":
        raise ValueError("not a BAM file")
    at = 8 + struct.unpack("<i", stream.get(4, 4))[0]
    n = struct.unpack("<i", stream.get(at, 4))[0]
    at += 4
    for _ in range(n):
        at += 8 + struct.unpack("<i", stream.get(at, 4))[0]
    return at, n


def _is_record(stream: _Stream, at: int, refs: int) -> int:
    """The place after the record that begins at a place, or 0 if none can; at the file's end it is the place itself."""
    if not stream.has(at + 1):
        return at
    if not stream.has(at + 36):
        return 0
    size, ref, pos, name, _, _, cigar, _, length, next_ref, next_pos, _ = struct.unpack("<iiiBBHHHiiii", stream.get(at, 36))
    least = 32 + name + 4 * cigar + (length + 1) // 2 + length
    if name < 1 or length < 0 or size < least or not -1 <= ref < max(refs, 1) or not -1 <= next_ref < max(refs, 1) or pos < -1 or next_pos < -1:
        return 0
    if not stream.has(at + 36 + name):
        return 0
    text = stream.get(at + 36, name)
    return at + 4 + size if text[-1] == 0 and all(33 <= c <= 126 for c in text[:-1]) else 0


def _first_record(stream: _Stream, refs: int) -> int | None:
    at = 0
    while stream.has(at + 1):
        end, left = at, CHAIN + 1
        while left and (after := _is_record(stream, end, refs)):
            if after == end:  # the end of the file
                return at
            end, left = after, left - 1
        if not left:
            return at
        at += 1
    return None


def _record(body: bytes) -> tuple[str, int, str, str | None]:
    name, cigar, flag, length = body[8], struct.unpack_from("<H", body, 12)[0], struct.unpack_from("<H", body, 14)[0], struct.unpack_from("<i", body, 16)[0]
    at = 32 + name + 4 * cigar
    seq = "".join(map(_PAIRS.__getitem__, body[at : at + (length + 1) // 2]))[:length]
    qual = body[at + (length + 1) // 2 : at + (length + 1) // 2 + length]
    qual = None if qual[:1] == b"\xff" else bytes(q + 33 for q in qual).decode("latin-1")
    if flag & REVERSE:
        seq, qual = seq[::-1].translate(_TURN), qual and qual[::-1]
    return body[32 : 32 + name - 1].decode("latin-1"), flag, seq, qual


@dataclass
class _Split(InputPartition):
    path: str
    start: int
    end: int
    size: int


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.paths, self.split = options["path"], int(options.get("splitbytes", 128 << 20))

    def partitions(self):
        out = []
        for path in self.paths.split(","):
            system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
            info = system.get_file_info(name)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(path)
            found = [info] if info.is_file else [x for x in system.get_file_info(fs.FileSelector(name, recursive=True)) if x.path.endswith(".bam")]
            where = path.split("://")[0] + "://" if "://" in path else ""
            out += [_Split(where + x.path, a, min(a + self.split, x.size), x.size) for x in found for a in range(0, x.size, self.split)]
        return out

    def read(self, split):
        system, name = fs.FileSystem.from_uri(split.path) if "://" in split.path else (fs.LocalFileSystem(), split.path)
        with system.open_input_file(name) as file:
            blocks = _Blocks(file, split.size)
            head = _Stream(blocks.data(0))
            at, refs = _header_end(head)
            stream = head
            if split.start:
                first = blocks.first(split.start)
                if first >= split.end:
                    return
                stream = _Stream(blocks.data(first))
                at = _first_record(stream, refs)
            rows: list[tuple] = []
            while at is not None and stream.has(at + 1) and stream.block(at) < split.end:
                size = struct.unpack("<i", stream.get(at, 4))[0]
                id_, flag, seq, qual = _record(stream.get(at + 4, size))
                if not flag & NOT_PRIMARY:
                    rows.append((split.path.rsplit("/", 1)[-1], id_, flag, seq, qual))
                at += 4 + size
                stream.drop(at)
                if len(rows) == 2000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["file", "id", "flag", "seq", "qual"])


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "reads_bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def read_bam(spark: SparkSession, path: str, split_bytes: int = 128 << 20) -> DataFrame:
    """(file, SampleID, id, seq, qual) of a BAM file's primary reads, or of those of all .bam files below a folder, in the
    orientation in which they were read; qual is null where the file has none. Other files of a comma-separated list follow."""
    spark.dataSource.register(BamSource)
    rows = spark.read.format("reads_bam").option("splitBytes", split_bytes).load(path)
    return rows.select("file", F.regexp_replace("file", r"\.bam$", "").alias("SampleID"), "id", "seq", "qual")
