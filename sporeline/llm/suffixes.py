"""Removal of passages that repeat across documents, by merged Burrows-Wheeler transforms.

Every byte covered by a string of WINDOW bytes that also starts in a document with a smaller doc_id goes. Each window is
filed under its anchor, the least hash among its ANCHOR-byte substrings, so equal windows have equal anchors; a run of
windows with one anchor is one string. Only strings whose anchor stands in two documents travel (blocks of documents ask,
as in ``ppm``, and are told which of their anchors do). They meet others of their anchor in a group of bounded size, each
distinct string once with its least doc_id. There:

* the strings are dealt to shards, and each shard's suffixes are sorted once, which gives its transform;
* the shards' transforms are merged by refining their interleave: at step h the rows stand in the order of their first h
  bytes, and one stable sort by the byte before each row gives step h + 1. A row whose first h bytes no other row has is
  final and takes no further part. Rows that share h bytes are an interval, so after WINDOW steps the intervals left are
  the repeated windows, whatever shard they are from; no suffix is compared with another again.

The least doc_id of an interval is what its windows are judged by. An anchor with more than ``hot`` asks has its windows
travel one by one, dealt by their own hash, so boilerplate with ever new surroundings isn't one task's.

Defined cases: a null text is an empty text; texts shorter than WINDOW lose nothing; a null doc_id counts as larger than
all others, and equal doc_ids (repeated rows) take nothing from each other; an empty table gives no rows; columns other
than doc_id and text are dropped. Bytes 0xFF, which UTF-8 doesn't have, count as 0xFE in the order of suffixes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.llm.common import batches_of, release, settle, table

WINDOW = 50
#: Text bytes of a block, and for which a bucket of anchors or a group of strings is made: they bound what a task holds.
BLOCK_BYTES, BUCKET_BYTES, GROUP_BYTES = 16_000_000, 24_000_000, 4_000_000
#: Bytes of a shard whose suffixes are sorted together.
SHARD_BYTES = 1_000_000
#: Text bytes whose anchors are found at once.
PART = 1_000_000
#: Asks for an anchor from which its windows travel one by one.
HOT = 200_000
NO_ID = np.iinfo(np.int64).max
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_LOW40 = np.uint64((1 << 40) - 1)


def anchor_bytes(window: int) -> int:
    return max(8, 2 * window // 5)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def _least_hashes(data: bytes, window: int) -> np.ndarray:
    """For each place at which a window starts, the least hash of the anchor-long substrings in it."""
    k = anchor_bytes(window)
    n = len(data) - k + 1
    h = np.zeros(n, np.uint64)
    for i, at in enumerate(range(0, k, 8)):
        h ^= np.ndarray((n,), "<u8", data, min(at, k - 8), (1,)) * _MIX[i % 4]
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    wide, have = window - k + 1, 1
    while 2 * have <= wide:
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    return np.minimum(h[: len(h) - (wide - have)], h[wide - have :]) if have < wide else h


def _runs_of(data: bytes, ends: np.ndarray, window: int):
    """(row, start, end, anchor) arrays of the runs of windows with one anchor in texts that stand one after another."""
    if len(data) < window:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    least = _least_hashes(data, window)
    row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: len(least)]
    fits = np.arange(len(least)) + window <= ends[row]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | (fits[1:] != fits[:-1])
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(least)) + window - 1
    keep = fits[start]
    start, end = start[keep], end[keep]
    return row[start], start, end, least[start]


def _parts(batches, window: int) -> Iterator[tuple]:
    """(first row, bytes, where each row begins in them, place of the first row's bytes in its text, runs) over the texts
    in column 1.

    Short texts are taken together. A long one is alone, in parts that overlap by window - 1 bytes; where they are cut
    depends on the text alone.
    """
    first = 0
    for batch in batches:
        for lot in batches_of(batch, 1, PART):
            short: list[bytes] = []
            for text in [*lot.column(1).to_pylist(), ...]:
                if text is None or text is not ... and len(text) <= PART:
                    short.append(text or b"")
                    continue
                if short:
                    data, ends = b"".join(short), np.cumsum([len(x) for x in short])
                    yield first, data, np.append(0, ends[:-1]), 0, _runs_of(data, ends, window)
                    first += len(short)
                    short = []
                if text is not ...:
                    for at in range(0, len(text) - window + 1, PART):
                        data = text[at : at + PART + window - 1]
                        yield first, data, np.zeros(1, np.int64), at, _runs_of(data, np.array([len(data)]), window)
                    first += 1


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, as they cross the cluster twice."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = pa.array([x and squeeze(x) for x in batch.column(1).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), texts, batch.column(2)], ["doc_id", "text", "block"])


def _plain(block: pa.Table) -> Iterator[pa.RecordBatch]:
    """A block's rows, a few at a time, with their texts as they were."""
    expand = zstandard.ZstdDecompressor().decompress
    for batch in block.select(["doc_id", "text"]).to_batches(max_chunksize=500):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x and expand(x) for x in batch.column(1).to_pylist()], pa.binary())], ["doc_id", "text"])


def _keys(anchors: np.ndarray) -> np.ndarray:
    """40 bits of an anchor: enough to tell what may be repeated."""
    return _mixed(anchors) & _LOW40


def _packed(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpacked(blobs) -> np.ndarray:
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view("<u8").ravel()


def _ask(window: int, buckets: int):
    """Each block's distinct anchors, by bucket; an anchor of several texts of one block and part is given twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column(2).to_numpy()
            for first, _, _, _, (row, _, _, anchor) in _parts([batch], window):
                if not len(row):
                    continue
                key, block = _keys(anchor), blocks[first + row]
                order = np.lexsort((row, key))
                key, block, row = key[order], block[order], row[order]
                same = key[1:] == key[:-1]
                fresh = np.append(True, ~same | (row[1:] != row[:-1]))  # distinct anchors of each text
                key, block = key[fresh], block[fresh]
                begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                nth = np.arange(len(key)) - np.repeat(begin, np.diff(np.append(begin, len(key))))
                bucket = ((key >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((key, block, bucket))
                bucket, block, key, nth = bucket[order], block[order], key[order], nth[order]
                again = np.append(False, (key[1:] == key[:-1]) & (block[1:] == block[:-1]) & (bucket[1:] == bucket[:-1]))
                keep = ~again | (nth <= 1)
                bucket, block, key = bucket[keep], block[keep], key[keep]
                at = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])))
                size = np.diff(np.append(at, len(key)))
                start = np.flatnonzero(np.append(True, bucket[at][1:] != bucket[at][:-1]))
                stop = np.append(start[1:], len(at))
                out = []
                for a, b in zip(start.tolist(), stop.tolist()):
                    low, high = at[a], at[b] if b < len(at) else len(key)
                    out.append((int(bucket[low]), block[at[a:b]].astype("<i4").tobytes(), size[a:b].astype("<i4").tobytes(), _packed(key[low:high])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["bucket", "blocks", "sizes", "keys"])
        release()

    return run


def _answer(hot: int):
    """For each block its anchors that are asked for twice, and those of them that are hot."""

    def run(asks: pa.Table) -> pa.Table:
        key = _unpacked(asks.column("keys").to_pylist())
        block, size = (np.frombuffer(b"".join(asks.column(c).to_pylist()), "<i4") for c in ("blocks", "sizes"))
        block = np.repeat(block, size)
        order = np.argsort(key, kind="stable")
        key, block = key[order], block[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(begin, len(key)))
        often = np.repeat(count, count)
        keep = often > 1
        key, block, often = key[keep], block[keep], often[keep]
        order = np.argsort(block, kind="stable")
        key, block, often = key[order], block[order], often[order]
        begin = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(key) else np.zeros(0, np.int64)
        out = ([], [], [])
        for a, b in zip(begin.tolist(), np.append(begin[1:], len(key)).tolist() if len(key) else []):
            k, h = key[a:b], often[a:b] > hot
            for column, value in zip(out, (int(block[a]), _packed(np.unique(k)), _packed(np.unique(k[h])))):
                column.append(value)
        del asks, key, block
        release()
        return pa.table([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], ["block", "keys", "hot"])

    return run


def _within(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each key is in the sorted array known."""
    if not len(known):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(known, keys)
    at[at == len(known)] = 0
    return known[at] == keys


def _strings(block: pa.Table, keys: np.ndarray, hot: np.ndarray, window: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(row, place in the row, key, string) of the runs under keys; of those under hot ones, of each window alone."""
    for first, data, begins, base, (row, start, end, anchor) in _parts(_plain(block), window):
        key = _keys(anchor)
        some = np.flatnonzero(_within(key, keys))
        warm = _within(key[some], hot)
        place = start[some] - begins[row[some]] + base
        for r, p, k, a, b, h in zip((row[some] + first).tolist(), place.tolist(), key[some].tolist(), start[some].tolist(), end[some].tolist(), warm.tolist()):
            if h:
                for at in range(a, b - window + 1):
                    yield r, p + at - a, k, data[at : at + window]
            else:
                yield r, p, k, data[a:b]


def suffix_order(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of data in the order of their suffixes. Strings end with 0 at ``ends``, where the suffix is cut; suffixes
    that are equal stand in the order of their strings."""
    n, strings = len(data), np.arange(len(ends))
    string = np.repeat(strings, np.diff(ends, prepend=-1))
    left = ends[string] - np.arange(n)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).tobytes()
    head = np.ndarray((n,), ">u8", padded, 0, (1,)).astype(np.uint64)
    cut = np.where(left < 8, 8 * (8 - left), 0).astype(np.uint64)
    head = np.where(left == 0, 0, (head >> np.minimum(cut, 63)) << np.minimum(cut, 63)).astype(np.uint64)
    order = np.argsort(head, kind="stable")
    sorted_head = head[order]
    begin = np.flatnonzero(np.append(True, sorted_head[1:] != sorted_head[:-1]))
    size = np.diff(np.append(begin, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(begin, size)
    slots = np.flatnonzero(np.repeat(size > 1, size))
    reach = 8
    while len(slots):
        own = order[slots]
        further = left[own] >= reach
        second = np.where(further, len(ends) + rank[np.minimum(own + reach, n - 1)], string[own])
        key = (rank[own].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        by = np.argsort(key, kind="stable")
        own, key = own[by], key[by]
        order[slots] = own
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(begin, len(key)))
        rank[own] = np.repeat(slots[begin], size)
        slots = slots[np.repeat(size > 1, size)]
        reach *= 2
    return order


def repeated_windows(strings: list[bytes], window: int = WINDOW, shard_bytes: int = SHARD_BYTES):
    """(interval, string, place) of each window that two strings, or two places, have: windows of one interval are equal.

    Intervals are numbered in the order of their windows' bytes.
    """
    bwt, follow, place_string, place_at, base = [], [], [], [], 0
    lot: list[int] = []
    size = 0
    for i in range(len(strings) + 1):
        if lot and (i == len(strings) or size + len(strings[i]) > shard_bytes):
            joined = b"\0".join([*(strings[j] for j in lot), b""])
            lengths = np.array([len(strings[j]) for j in lot])
            ends = np.cumsum(lengths + 1) - 1
            data = np.frombuffer(joined, np.uint8)
            data = np.minimum(data, 254) + np.uint8(1)
            data[ends] = 0
            order = suffix_order(data, ends)
            own = np.where(order > 0, data[order - 1], 0)  # the shard's transform: the byte before each suffix
            to = np.empty(len(own), np.int32)
            to[np.argsort(own, kind="stable")] = np.arange(len(own))  # where a suffix with that byte put before it stands
            bwt.append(own)
            follow.append(to + base)
            string = np.repeat(np.arange(len(lot)), lengths + 1)
            place_string.append(np.array(lot)[string[order]].astype(np.int32))
            place_at.append((order - np.append(0, ends[:-1] + 1)[string[order]]).astype(np.int32))
            base += len(own)
            lot, size = [], 0
        if i < len(strings):
            lot.append(i)
            size += len(strings[i]) + 1
    if not base:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    bwt, follow = np.concatenate(bwt), np.concatenate(follow)
    rows, interval = np.arange(base, dtype=np.int32), np.zeros(base, np.int32)
    for _ in range(window):
        before = bwt[rows]
        real = np.flatnonzero(before)
        by = real[np.argsort(before[real], kind="stable")]
        before, rows, interval = before[by], follow[rows[by]], interval[by]
        new = np.ones(len(rows) + 1, bool)
        new[1:-1] = (before[1:] != before[:-1]) | (interval[1:] != interval[:-1])
        kept = np.flatnonzero(~(new[:-1] & new[1:]))  # rows alone in their interval are final
        rows = rows[kept]
        interval = np.cumsum(new[:-1], dtype=np.int32)[kept]
    place_string, place_at = np.concatenate(place_string), np.concatenate(place_at)
    return interval, place_string[rows], place_at[rows]


def _pack_strings(strings: list[bytes], key: np.ndarray, doc: np.ndarray, many: np.ndarray, hot: np.ndarray) -> bytes:
    flags = (many.astype(np.uint8) | (hot.astype(np.uint8) << 1)).tobytes()
    sizes = np.array([len(x) for x in strings], "<i4").tobytes()
    raw = [np.array([len(strings)], "<i8").tobytes(), sizes, flags, _packed(key.astype(np.uint64)), doc.astype("<i8").tobytes(), *strings]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(raw))


def _unpack_strings(blob: bytes):
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(raw[:8], "little")
    sizes, flags = np.frombuffer(raw, "<i4", n, 8), np.frombuffer(raw, np.uint8, n, 8 + 4 * n)
    key, doc = _unpacked([raw[8 + 5 * n : 8 + 10 * n]]), np.frombuffer(raw[8 + 10 * n : 8 + 18 * n], "<i8")
    ends = (8 + 18 * n + np.cumsum(sizes, dtype=np.int64)).tolist()
    strings = [raw[b - size : b] for b, size in zip(ends, sizes.tolist())]
    return strings, key.astype(np.int64), doc, (flags & 1).astype(bool), (flags & 2).astype(bool)


def _merge(window: int, shard_bytes: int):
    """For each string, what least doc_id each of its windows has anywhere, told to the blocks that it may concern."""

    def run(group: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        codes, keys, docs, many_of, hot_of, blocks = [], [], [], [], [], []
        for row in group.to_batches(max_chunksize=1):
            block, packed = row.column(1)[0].as_py(), row.column(2)[0].as_py()
            found, key, doc, many, hot = _unpack_strings(packed)
            codes.append(np.fromiter((number.setdefault(x, len(number)) for x in found), np.int64, len(found)))
            for column, values in ((keys, key), (docs, doc), (many_of, many), (hot_of, hot), (blocks, np.full(len(found), block, np.int32))):
                column.append(values)
        strings, code = list(number), np.concatenate(codes)
        doc, many, block = np.concatenate(docs), np.concatenate(many_of), np.concatenate(blocks)
        del number, group
        key = np.zeros(len(strings), np.int64)
        key[code] = np.concatenate(keys)
        least = np.full(len(strings), NO_ID)
        np.minimum.at(least, code, doc)
        warm = np.zeros(len(strings), bool)
        warm[code] = np.concatenate(hot_of)
        _, anchor, often = np.unique(key, return_inverse=True, return_counts=True)
        shared = np.flatnonzero(often[anchor] > 1)  # a string that is alone under its anchor has no window in common
        pieces: dict[int, tuple[list[int], list[int]]] = {}
        interval, which, at = repeated_windows([strings[i] for i in shared.tolist()], window, shard_bytes)
        if len(interval):
            which = shared[which]
            begin = np.flatnonzero(np.append(True, interval[1:] != interval[:-1]))
            best = np.repeat(np.minimum.reduceat(least[which], begin), np.diff(np.append(begin, len(interval))))
            lower = best < least[which]
            which, at, best = which[lower], at[lower], best[lower]
            order = np.lexsort((at, which))
            which, at, best = which[order], at[order], best[order]
            cut = np.flatnonzero(np.append(True, which[1:] != which[:-1])) if len(which) else np.zeros(0, np.int64)
            for a, b in zip(cut.tolist(), np.append(cut[1:], len(which)).tolist() if len(which) else []):
                i = int(which[a])
                mins = np.full(len(strings[i]) - window + 1, least[i])
                mins[at[a:b]] = best[a:b]
                first = np.flatnonzero(np.append(True, mins[1:] != mins[:-1]))
                pieces[i] = (first.tolist(), mins[first].tolist())
        told = np.flatnonzero(many | (doc > least[code]) | np.isin(code, np.fromiter(pieces, np.int64, len(pieces))))
        told = told[np.argsort(block[told], kind="stable")]
        out: list[tuple] = []
        begin = np.flatnonzero(np.append(True, np.diff(block[told]) != 0)) if len(told) else np.zeros(0, np.int64)
        for a, b in zip(begin.tolist(), np.append(begin[1:], len(told)).tolist() if len(told) else []):
            own = code[told[a:b]]
            under = key[own].astype(np.uint64)
            own, under_hot = own.tolist(), np.unique(under[warm[own]])
            each = [pieces.get(i) or ([0], [int(least[i])]) for i in own]
            out.append((
                int(block[told[a]]), b"".join(xxhash.xxh3_128_digest(strings[i]) for i in own), _packed(under), _packed(under_hot),
                np.array([len(x[0]) for x in each], "<i4").tobytes(), np.array([y for x in each for y in x[0]], "<i4").tobytes(),
                np.array([y for x in each for y in x[1]], "<i8").tobytes(),
            ))
        names = ["block", "digests", "keys", "hot", "sizes", "starts", "docs"]
        result = pa.table([pa.array([x[i] for x in out], pa.binary() if i else pa.int32()) for i in range(7)], names)
        del strings
        release()
        return result

    return run


def _tell(window: int, groups: int):
    """A block's distinct strings under the anchors that it was told of, with the least doc_id, in a row for each group."""

    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        keys, hot = (np.unique(_unpacked(told.column(c).to_pylist())) for c in ("keys", "hot"))
        ids = block.column("doc_id").fill_null(NO_ID).to_pylist()
        number = block.column("block")[0].as_py() if block.num_rows else 0
        found: dict[bytes, list[int]] = {}  # string: anchor, least doc_id, whether another document has it
        for row, _, key, string in _strings(block, keys, hot, window):
            doc = ids[row]
            have = found.setdefault(string, [key, doc, 0])
            if doc != have[1]:
                have[1:] = min(doc, have[1]), 1
        key, doc, many = (np.fromiter((x[i] for x in found.values()), np.int64, len(found)) for i in range(3))
        is_hot, strings = _within(key.astype(np.uint64), hot), list(found)
        under = key.astype(np.uint64)
        for i in np.flatnonzero(is_hot).tolist():  # dealt by the window itself
            under[i] = xxhash.xxh64_intdigest(strings[i])
        group = (_mixed(under) % np.uint64(groups)).astype(np.int32)
        order = np.lexsort((key, group))
        begin = np.flatnonzero(np.append(True, np.diff(group[order]) != 0)) if len(order) else np.zeros(0, np.int64)
        rows: tuple[list, list] = ([], [])
        for own in np.split(order, begin[1:]) if len(order) else []:
            rows[0].append(int(group[own[0]]))
            rows[1].append(_pack_strings([strings[i] for i in own.tolist()], key[own], doc[own], many[own], is_hot[own]))
        del found, block, strings
        release()
        return pa.table([pa.array(rows[0], pa.int32()), pa.array(np.full(len(rows[0]), number, np.int32)), pa.array(rows[1], pa.binary())], ["group", "block", "strings"])

    return run


def _cut(window: int):
    """The block's texts without the bytes that their windows lose."""

    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        raw = {c: told.column(c).to_pylist() for c in ("digests", "keys", "hot", "sizes", "starts", "docs")}
        keys, hot = (np.unique(_unpacked(raw[c])) for c in ("keys", "hot"))
        digests = b"".join(raw["digests"])
        number = {digests[at : at + 16]: i for i, at in enumerate(range(0, len(digests), 16))}
        sizes, starts = (np.frombuffer(b"".join(raw[c]), "<i4") for c in ("sizes", "starts"))
        upto = np.append(0, np.cumsum(sizes)).tolist()
        starts, docs = starts.tolist(), np.frombuffer(b"".join(raw["docs"]), "<i8").tolist()
        ids = block.column("doc_id").fill_null(NO_ID).to_pylist()
        gone: dict[int, list[tuple[int, int]]] = {}
        for row, place, _, string in _strings(block, keys, hot, window):
            i = number.get(xxhash.xxh3_128_digest(string))
            if i is None:
                continue
            for j in range(upto[i], upto[i + 1]):
                if docs[j] < ids[row]:
                    end = len(string) if j + 1 == upto[i + 1] else starts[j + 1] - 1 + window
                    gone.setdefault(row, []).append((place + starts[j], place + end))
        kept, spans, lengths = [], [], []
        row = 0
        for batch in _plain(block):
            for text in batch.column(1).to_pylist():
                text, merged = text or b"", []
                for a, b in sorted(gone.get(row, ())):
                    if merged and a <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], b)
                    else:
                        merged.append({"start": a, "end": b})
                at, left = 0, []
                for x in merged:
                    left.append(text[at : x["start"]])
                    at = x["end"]
                kept.append(b"".join([*left, text[at:]]) if merged else text)
                spans.append(merged)
                lengths.append(len(text))
                row += 1
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        out = pa.table([block.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])
        del block, told, raw, number, kept, gone
        release()
        return out

    return run


def drop_repeated(docs: DataFrame, window: int = WINDOW, hot: int = HOT, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of docs(doc_id, text): the removed spans, as [start, end) in bytes, and what is left.

    ``window`` is at least 8 bytes.
    """
    size = int(docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    share = lambda each: max(1, -(-size // each))
    blocks, buckets, groups = share(block_bytes), share(BUCKET_BYTES), share(GROUP_BYTES)
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), number)
    asks = rows.mapInArrow(_ask(window, buckets), "bucket int, blocks binary, sizes binary, keys binary")
    answers = settle(asks.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_answer(hot), "block int, keys binary, hot binary"))
    squeezed = rows.mapInArrow(_squeezed, "doc_id long, text binary, block int")
    blocked = squeezed.repartition(blocks, "block").groupBy("block")
    strings = blocked.cogroup(answers.groupBy("block")).applyInArrow(
        _tell(window, groups), "group int, block int, strings binary"
    )
    schema = "block int, digests binary, keys binary, hot binary, sizes binary, starts binary, docs binary"
    told = settle(strings.repartition(groups, "group").groupBy("group").applyInArrow(_merge(window, shard_bytes), schema))
    schema = "doc_id long, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary"
    return blocked.cogroup(told.groupBy("block")).applyInArrow(_cut(window), schema)


def op13_suffix_dedup(spark, sf_dir):
    out = drop_repeated(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES, ORACLES = {"op13_suffix_dedup": op13_suffix_dedup}, {}
