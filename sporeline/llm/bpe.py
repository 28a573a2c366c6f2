"""Byte-level BPE encoding and decoding with merge ranks.

A text is cut into pieces by the vocabulary's pattern and each piece is merged by itself: of all live neighbours the
leftmost pair of lowest rank becomes one token, until no pair has a rank. A segment tree over the piece's byte
positions holds at each inner node the least (rank, position) of its span; a merge changes the pairs of the merged
token and of its left neighbour, and removes that of the right one, so it costs three point updates of logarithmic
length instead of a scan. Pieces of up to SHORT bytes that are new to a worker are merged together, one tree per row of
an array; longer ones go through the same tree one by one.

A batch's distinct units (a word with the space before it) are numbered by Arrow, and only those are looked up. Workers
remember units up to a bounded number, as most recur.

Defined cases: a null text is an empty text, with no tokens; repeated rows are encoded alike; an empty table gives an
empty result; very long texts and pieces take n log n; extra columns are kept unless they have a result column's name.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.llm.common import batches_of, release, table

#: Longest piece, in bytes, that is merged in a batch.
SHORT = 32
#: Short pieces that are merged together; their trees stay in a core's cache.
ROWS = 4_000
#: Units of a generation, of which a worker remembers two; at about 250 bytes each some 200 MB.
REMEMBERED = 400_000
#: Bytes of texts that are cut into units at once, about.
BATCH_BYTES = 8_000_000
NONE = np.int64(1) << 40

# The white space of the pattern, as Unicode's White_Space property has it.
SPACE = r"\t-\r \x85\xa0  -     　"


class Vocabulary:
    """Ranks of a rank file, and the pairs that merge: (left id, right id) -> id of both together."""

    def __init__(self, lines: bytes, pattern: str):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.bytes_of = [b""] * self.size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.pairs = pairs
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        # Open addressing at a load under a quarter; looked up for whole arrays at once.
        bits = int(len(pairs) * 4).bit_length()
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NONE, np.int64)
        values = np.fromiter(pairs.values(), np.int64, len(pairs))
        at, left = self._slot(keys), np.arange(len(keys))
        self.probes = 1
        while len(left):
            free = left[self.slots[at[left]] == -1]
            first = free[np.unique(at[free], return_index=True)[1]]
            self.slots[at[first]], self.values[at[first]] = keys[first], values[first]
            left = left[self.slots[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (len(self.slots) - 1)
            self.probes += bool(len(left))
        # In the pattern \s is spelt out, as libraries differ on it.
        own = pattern.replace(r"[^\s\p{L}", rf"[^{SPACE}\p{{L}}").replace(r"(?!\S)", rf"(?![^{SPACE}])").replace(r"\s", f"[{SPACE}]")
        self.pieces = regex.compile(own, regex.V0).findall
        #: What a word doesn't begin with: texts with a space before it, or at the end, are not cut at spaces.
        space = regex.compile(f"[{SPACE}\x1c-\x1f]").match
        self.white = frozenset(c for c in map(chr, range(0x3001)) if space(c))
        self.tokens = pa.array(self.bytes_of, pa.large_binary())
        self.units: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NONE where there is none (negative ids have none)."""
        key = left * self.size + right
        at = self._slot(key)
        out = np.full(key.shape, NONE, np.int64)
        live = np.flatnonzero((left >= 0) & (right >= 0))
        for _ in range(self.probes):
            held = self.slots[at[live]]
            hit = held == key[live]
            out[live[hit]] = self.values[at[live[hit]]]
            live = live[~hit & (held != -1)]
            if not len(live):
                break
            at[live] = (at[live] + 1) & (len(self.slots) - 1)
        return out

    def merge_long(self, piece: bytes) -> list[int]:
        """One piece by its segment tree. Nodes hold rank * n + position, so the least is the leftmost of lowest rank."""
        n = len(piece)
        ids = [int(self.byte_id[b]) for b in piece]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        size = 1 << max(1, (n - 1).bit_length())
        top = int(NONE) * n
        tree = [top] * (2 * size)
        pairs, width = self.pairs, self.size
        for p in range(n - 1):
            rank = pairs.get(ids[p] * width + ids[p + 1])
            if rank is not None:
                tree[size + p] = rank * n + p
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(p: int, value: int) -> None:
            k = size + p
            tree[k] = value
            while k > 1:
                k >>= 1
                a, b = tree[2 * k], tree[2 * k + 1]
                value = a if a < b else b
                if tree[k] == value:
                    break
                tree[k] = value

        while tree[1] < top:
            rank, p = divmod(tree[1], n)
            q = nxt[p]
            ids[p], nxt[p] = rank, nxt[q]
            if nxt[q] < n:
                prv[nxt[q]] = p
                after = pairs.get(rank * width + ids[nxt[q]])
            else:
                after = None
            put(q, top)
            put(p, top if after is None else after * n + p)
            if prv[p] >= 0:
                before = pairs.get(ids[prv[p]] * width + rank)
                put(prv[p], top if before is None else before * n + prv[p])
        out, p = [], 0
        while p < n:
            out.append(ids[p])
            p = nxt[p]
        return out

    def merge_short(self, pieces: list[bytes]) -> list[bytes]:
        """Pieces of 1 to SHORT bytes, each row an array's segment tree; ids as little-endian unsigned 32-bit integers."""
        return [x for at in range(0, len(pieces), ROWS) for x in self._merge_rows(pieces[at : at + ROWS])]

    def _merge_rows(self, pieces: list[bytes]) -> list[bytes]:
        """Positions are numbered through all rows, whose size is a power of two: above position p of a level stands p // 2.
        The number after the last row's is before and after every row's ends; it has no id, and what is noted at it isn't read."""
        m = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, m)
        bits = max(1, int(lengths.max() - 1).bit_length())
        size = 1 << bits
        raw = np.frombuffer(b"".join([p.ljust(size, b"\0") for p in pieces]), np.uint8)
        ids = np.full((m + 1) * size, -1, np.int64)
        ids[: m * size] = np.where((np.arange(size) < lengths[:, None]).ravel(), self.byte_id[raw], -1)
        nxt, prv = np.arange(1, m * size + 2), np.arange(-1, m * size)
        nxt[size - 1 :: size], prv[::size] = m * size, m * size
        # Nodes hold rank * size + position in the row, so the least is the leftmost of lowest rank.
        top = NONE << bits
        column = np.arange(size)
        leaves = np.full((m + 1, size), top, np.int64)
        table = ids[: m * size].reshape(m, size)
        leaves[:m, :-1] = np.minimum((self.rank_of(table[:, :-1].ravel(), table[:, 1:].ravel()).reshape(m, size - 1) << bits) + column[:-1], top)
        levels = [leaves.ravel()]
        for _ in range(bits):
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        rows = np.flatnonzero(levels[-1][:m] < top)
        while len(rows):
            least = levels[-1][rows]
            p, new = (rows << bits) + (least & (size - 1)), least >> bits
            q = nxt[p]
            r = nxt[q]
            o = prv[p]
            ids[p], ids[q] = new, -1
            nxt[p], prv[r] = r, p
            ranks = self.rank_of(np.concatenate([new, ids[o]]), np.concatenate([ids[r], new]))
            at = np.concatenate([q, p, o])
            levels[0][q] = top
            levels[0][at[len(q) :]] = np.minimum((ranks << bits) + (at[len(q) :] & (size - 1)), top)
            for below, level in zip(levels, levels[1:]):
                at = at >> 1
                level[at] = np.minimum(below[2 * at], below[2 * at + 1])
            rows = rows[levels[-1][rows] < top]
        live = ids[: m * size].reshape(m, size) >= 0
        flat = ids[: m * size][live.ravel()].astype("<u4").tobytes()
        ends = (np.cumsum(live.sum(1)) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids in each); null is an empty text. Distinct words are numbered, and their ids are gathered for
        the whole batch at once."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        # Where every space begins a word, a piece can't end in it: cutting before spaces cuts no piece. A text with
        # another space is cut into pieces whole; it is a unit of its own then, and its words have no ids.
        words = pc.split_pattern(texts, " ")
        coded = words.flatten().dictionary_encode()
        distinct, at = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        n_words = pc.list_value_length(words).to_numpy()
        first = np.cumsum(n_words) - n_words
        white = np.fromiter((not w or w[0] in self.white for w in distinct), bool, len(distinct))[at]
        white[first] = False
        odd = np.add.reduceat(white, first, dtype=np.int64) > 0
        # The first word has no space before it.
        heads = [self.pieces(texts[i].as_py()) if o else [w] if (w := distinct[k]) else [] for i, (o, k) in enumerate(zip(odd.tolist(), at[first].tolist()))]
        inner = ~np.repeat(odd, n_words)
        inner[first] = False
        used = np.zeros(len(distinct), bool)
        used[at[inner]] = True
        spaced = [" " + distinct[i] for i in np.flatnonzero(used).tolist()]
        known = self._known({*spaced, *itertools.chain.from_iterable(heads)})
        units = [known[u] for u in spaced] + [b"".join([known[u] for u in h]) for h in heads] + [b""]
        number = np.full(len(distinct), len(units) - 1)
        number[used] = np.arange(len(spaced))
        at = np.where(inner, number[at], len(units) - 1)
        at[first] = len(spaced) + np.arange(len(first))
        lengths = np.fromiter(map(len, units), np.int64, len(units)) // 4
        found = pa.array(units, pa.large_binary()).take(pa.array(at))
        ids = np.frombuffer(found.buffers()[2] or b"", "<u4")
        return ids, np.add.reduceat(lengths[at], first)

    def _known(self, units: set[str]) -> dict[str, bytes]:
        """All units remembered, those given among them. When a generation is full it becomes the one before, from which
        units in use are carried over."""
        if len(self.units) > REMEMBERED:
            self.units, self.before = {}, self.units
        known, before = self.units, self.before
        new = []
        for u in units.difference(known):
            if (ids := before.get(u)) is None:
                new.append(u)
            else:
                known[u] = ids
        if new:
            self._learn(new)
        return known

    def _learn(self, units: list[str]) -> None:
        """Encodes units and remembers them. Words after a space are cut into pieces as one text, by their spaces alone."""
        words = [u for u in units if len(u) > 1 and u[0] == " " and u[1] not in self.white]
        other = list(set(units).difference(words))
        parts = self.pieces("".join(words))
        starts = [i for i, p in enumerate(parts) if p[0] == " "]
        for u in other:
            starts.append(len(parts))
            parts += self.pieces(u)
        done = dict.fromkeys(parts)
        new: dict[str, bytes] = {}
        by_width: dict[int, dict[str, bytes]] = {}
        for p in done:
            # A piece is the unit of which it is all: words with and without marks have theirs in common.
            ids = self.units.get(p) or self.before.get(p)
            if ids is None:
                raw = p.encode()
                if (whole := self.ranks.get(raw)) is not None:
                    ids = whole.to_bytes(4, "little")
                elif len(raw) > SHORT:
                    ids = np.array(self.merge_long(raw), "<u4").tobytes()
                else:
                    by_width.setdefault((len(raw) - 1).bit_length(), {})[p] = raw
            done[p] = ids
        for same in by_width.values():
            new.update(zip(same, self.merge_short(list(same.values()))))
        done.update(new)
        self.units.update(new)
        for u, a, b in zip(words + other, starts, [*starts[1:], len(parts)]):
            if b - a == 1:
                self.units[u] = done[parts[a]]
            else:
                self.units[u] = b"".join([done[p] for p in parts[a:b]])

    def decode(self, ids: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
        """(the bytes of all ids, where each id's begin, and the end)."""
        found = self.tokens.take(pa.array(ids))
        return found.buffers()[2], np.frombuffer(found.buffers()[1], np.int64)[: len(ids) + 1]


_held: dict[tuple[int, str], Vocabulary] = {}


def vocabulary(lines: bytes, pattern: str) -> Vocabulary:
    """A worker's own copy, made once."""
    key = (hash(lines), pattern)
    if key not in _held:
        _held[key] = Vocabulary(lines, pattern)
    return _held[key]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", digest: bool = False) -> DataFrame:
    """docs with n_tokens and ids (array<int>), and the decoded text's bytes; a digest of both instead if asked for.

    path: a rank file on the driver. Its bytes, some hundred thousand lines at most, go to the workers with the code.
    """
    with open(path, "rb") as f:
        lines = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = [c for c in docs.columns if c not in ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")]
    at = kept.index(text)
    out = [docs.schema[c] for c in kept if c != text] if digest else [docs.schema[c] for c in kept]
    names = [x.name for x in out]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(lines.value, pattern)
        for whole in batches:
            for b in batches_of(whole, at, BATCH_BYTES):
                ids, counts = own.encode_batch(b.column(at))
                columns = [b.column(kept.index(c)) for c in names]
                ends = np.concatenate([[0], np.cumsum(counts)])
                decoded, begins = own.decode(ids)
                counts = pa.array(counts, pa.int64())
                if digest:
                    whole_of = ((memoryview(ids).cast("B"), ends * 4), (memoryview(decoded or b""), begins[ends]))
                    more = [pa.array([hashlib.sha256(x[i:j]).hexdigest() for i, j in zip(e[:-1].tolist(), e[1:].tolist())], pa.string()) for x, e in whole_of]
                    yield pa.RecordBatch.from_arrays([*columns, counts, *more], [*names, "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(begins[ends]), decoded])
                    more = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.view("<i4"))), texts.cast(pa.binary())]
                    yield pa.RecordBatch.from_arrays([*columns, counts, *more], [*names, "n_tokens", "ids", "decoded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from encoded(batches)
        release()  # after the last batch is let go; idle workers stay beside later stages

    tail = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "n_tokens long, ids array<int>, decoded binary"
    ddl = ", ".join([*[f"`{x.name}` {x.dataType.simpleString()}" for x in out], tail])
    return docs.select(*kept).mapInArrow(run, ddl)


def op1_byte_bpe(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digest=True)


QUERIES, ORACLES = {"op1_byte_bpe": op1_byte_bpe}, {}
