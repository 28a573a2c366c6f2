"""Language-model scores by prediction by partial matching (PPM).

A text is lower-cased (A-Z), its words are joined by one space and closed by a line feed; the model gives each byte's
probability after the ORDER bytes before it. The trie of byte contexts is kept as two tables, so it may grow with the
corpus: edges (order, context and symbol, count) and nodes (order, context, T: sum of counts, D: distinct symbols, E:
what the context's symbols count in the next shorter context). A symbol that follows its longest context has
probability c / (T + D). Otherwise the context is escaped with D / (T + D), and in the shorter one the symbols already
ruled out are excluded: T and D are lessened by the longer context's E and D. A context that was never seen costs
nothing; below order 0 all bytes left are equally likely. The model is learnt from the training rows and fixed.

Nothing is broadcast: each block of texts counts the distinct words and (ORDER + 1)-grams that occur in it, the counts of
training texts are added up over all blocks, each block's own are looked up in the model by joins, and the answers meet
the block's texts in one task. A block has a bounded number of
bytes (besides one text), and with it what it asks for.

Defined cases: a null text is an empty text with the end alone; repeated rows are scored alike; a null doc_id is in the
training part; an empty table gives no rows; without training rows all bytes are equally likely; very long texts are
handled in parts of PART bytes; columns other than doc_id and text are dropped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.llm.common import fold, release, settle, table

#: Bytes of context; at most 6, as context and symbol are held in a long.
ORDER = 5
#: Text bytes in a block, about: it bounds what one task holds.
BLOCK_BYTES = 25_000_000
#: Partitions for each block, so that few blocks share a task.
SPREAD = 4
#: Bytes whose grams are made at once.
PART = 500_000
#: Kinds of keys: a word by its 64-bit hash, or a gram by its bytes.
WORD_KEY, GRAM_KEY = 0, 1
END_KEY = -1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


def _codes(padded: bytes, order: int, n: int) -> np.ndarray:
    """Grams of the last n bytes of padded, which has 7 bytes more before them: eight bytes read at every place."""
    whole = np.ndarray((n,), ">u8", padded, 0, (1,)).astype(np.uint64)
    return (whole & np.uint64((1 << 8 * (order + 1)) - 1)).view(np.int64)


def grams(text: bytes, order: int) -> np.ndarray:
    """For each byte of the text, it and the ``order`` bytes before it in one integer; before the text are line feeds."""
    return _codes(b"\n" * 7 + text, order, len(text))


def _texts(words_by_row: list[list[bytes]]) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) - many short texts at once, a long text alone or last."""
    lot, size = [], 0
    for i, words in enumerate(words_by_row):
        lot.append(b" ".join(words) + b"\n")
        size += len(lot[-1])
        if size >= PART or i == len(words_by_row) - 1:
            yield i - len(lot) + 1, lot
            lot, size = [], 0


def _lot_grams(lot: list[bytes], order: int, with_rows: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """(grams, row within the lot if asked for) of a lot of texts, in parts of some PART bytes.

    The texts stand in one string with seven line feeds before each, so no gram reaches into the text before. A place
    belongs to a text unless it and the one before are line feeds; the one place of a text without words is added.
    """
    if len(lot) == 1 and len(lot[0]) > 2 * PART:
        text = b"\n" * 7 + lot[0]
        for at in range(0, len(lot[0]), PART):
            code = _codes(text[at : at + PART + 7], order, min(PART, len(lot[0]) - at))
            yield code, np.zeros(len(code), np.int64) if with_rows else None
        return
    joined = (b"\n" * 7).join([b"", *lot])
    code = _codes(joined, order, len(joined) - 7)
    a = np.frombuffer(joined, np.uint8)[6:]
    own = (a[1:] != 10) | (a[:-1] != 10)
    empty = np.flatnonzero([x == b"\n" for x in lot])
    blank = np.full(len(empty), int.from_bytes(b"\n" * (order + 1), "big"), np.int64)
    rows = None
    if with_rows:
        rows = np.concatenate([np.repeat(np.arange(len(lot)), [len(x) if x != b"\n" else 0 for x in lot]), empty])
    yield np.concatenate([code[own], blank]), rows


class Lookup:
    """Values by integer key for whole arrays: open addressing at a load of at most a half."""

    #: Keys that are put in at once, which bounds what is held besides the table.
    AT_ONCE = 250_000

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots, self.values, self.used = np.zeros(1 << bits, np.int64), np.zeros(1 << bits), np.zeros(1 << bits, bool)
        for start in range(0, len(keys), self.AT_ONCE):
            self._put(keys[start : start + self.AT_ONCE], values[start : start + self.AT_ONCE])

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[~self.used[at[left]]]
            first = free[np.unique(at[free], return_index=True)[1]]
            self.slots[at[first]], self.values[at[first]], self.used[at[first]] = keys[first], values[first], True
            left = left[(self.slots[at[left]] != keys[left])]
            at[left] = (at[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = self.values[at]
        left = np.flatnonzero((self.slots[at] != keys) | ~self.used[at])
        while len(left):
            if not self.used[at[left]].all():
                raise ValueError("a key was not answered")
            at[left] = (at[left] + 1) & self.mask
            hit = self.slots[at[left]] == keys[left]
            hit &= self.used[at[left]]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit]
        return out


class _Counts:
    """Keys and their counts, added up whenever PENDING new ones have come, so no more than these are held twice."""

    PENDING = 750_000

    def __init__(self):
        self.keys, self.counts, self.pending = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.pending += len(keys)
        if self.pending > self.PENDING:
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        self.keys, self.counts = [], []
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        del order
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
        self.keys, self.counts, self.pending = [keys[first]], [np.add.reduceat(counts, first) if len(first) else counts], 0
        return self.keys[0], self.counts[0]


def _rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int8)), pa.array(keys), pa.array(n)], ["kind", "key", "n"])


def _ask(order: int):
    """The distinct words and grams of a block, and how often each stands in its training texts."""

    def run(block: pa.Table) -> pa.Table:
        number = block.column("block")[0].as_py()
        words, found = _Counts(), _Counts()
        ends = 0
        for b in block.select(["text", "held_out"]).to_batches(max_chunksize=300):
            split = [words_of(t) for t in b.column(0).to_pylist()]
            held = b.column(1).to_pylist()
            ends += len(held) - sum(held)
            for part in (False, True):
                own = [w for w, h in zip(split, held) if h == part]
                n: Counter = Counter()
                for w in own:
                    n.update(w)
                words.add(word_keys(list(n)), np.zeros(len(n), np.int64) if part else np.fromiter(n.values(), np.int64, len(n)))
                for _, lot in _texts(own):
                    for code, _ in _lot_grams(lot, order):
                        k, n = np.unique(code, return_counts=True)
                        found.add(k, np.zeros(len(k), np.int64) if part else n)
        out = [_rows(WORD_KEY, *words.merged()), _rows(GRAM_KEY, *found.merged()), _rows(WORD_KEY, np.array([END_KEY]), np.array([ends]))]
        out = pa.Table.from_batches(out)
        del words, found, block
        release()
        return out.append_column("block", pa.array(np.full(out.num_rows, number, np.int32)))

    return run


def train(asked: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame, DataFrame]:
    """words (key, n), edges (ord, code, c) and nodes (ord, ctx, t, d, e) from the blocks' counts, all settled."""
    counted = settle(asked.groupBy("kind", "key").agg(F.sum("n").alias("n")).filter("n > 0"))
    words = counted.filter(F.col("kind") == WORD_KEY).select("key", "n")
    mask = F.expr("shiftleft(1L, 8 * (ord + 1)) - 1")
    edges = settle(
        counted.filter(F.col("kind") == GRAM_KEY)
        .select("key", "n", F.explode(F.sequence(F.lit(0), F.lit(order))).alias("ord"))
        .select("ord", F.col("key").bitwiseAND(mask).alias("code"), "n")
        .groupBy("ord", "code")
        .agg(F.sum("n").alias("c"))
    )
    shorter = edges.select((F.col("ord") + 1).alias("ord"), F.col("code").alias("tail"), F.col("c").alias("below"))
    with_below = edges.withColumn("tail", F.col("code").bitwiseAND(F.expr("shiftleft(1L, 8 * ord) - 1"))).join(shorter, ["ord", "tail"], "left")
    nodes = settle(
        with_below.groupBy("ord", F.shiftright("code", 8).alias("ctx")).agg(
            F.sum("c").alias("t"), F.count("*").alias("d"), F.coalesce(F.sum("below"), F.lit(0)).alias("e")
        )
    )
    return words, edges, nodes


def gram_scores(wanted: DataFrame, edges: DataFrame, nodes: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, value): log10 probability of each distinct gram of wanted(key)."""
    top = edges.filter(F.col("ord") == order).select(F.col("code").alias("key"), "c")
    top_nodes = nodes.filter(F.col("ord") == order).select("ctx", "t", "d")
    known = wanted.join(top, "key", "left")
    seen = known.filter("c is not null").withColumn("ctx", F.shiftright("key", 8)).join(top_nodes, "ctx")
    seen = seen.select("key", F.log10(F.col("c") / (F.col("t") + F.col("d"))).alias("value"))
    # The others, once for each order: what they and their context count there.
    levels = (
        known.filter("c is null")
        .select("key", F.explode(F.sequence(F.lit(0), F.lit(order))).alias("ord"))
        .select("key", "ord", F.col("key").bitwiseAND(F.expr("shiftleft(1L, 8 * (ord + 1)) - 1")).alias("code"))
        .withColumn("ctx", F.shiftright("code", 8))
        .join(edges, ["ord", "code"], "left")
        .join(nodes, ["ord", "ctx"], "left")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("ord", "c", "t", "d", "e")), asc=False).alias("levels"))
    )
    # From the longest context down. d0, e0: what the longer context excludes here.
    walk = """aggregate(levels, named_struct('lp', 0D, 'done', false, 'd0', 0L, 'e0', 0L), (a, x) ->
        if(a.done or x.t is null, a,
        if(x.c is not null,
           named_struct('lp', a.lp + log10(cast(x.c as double) / (x.t - a.e0 + x.d - a.d0)), 'done', true, 'd0', a.d0, 'e0', a.e0),
           named_struct('lp', a.lp + if(x.d = a.d0, 0D, log10(cast(x.d - a.d0 as double) / (x.t - a.e0 + x.d - a.d0))), 'done', false, 'd0', x.d, 'e0', x.e))),
        a -> a.lp + if(a.done, 0D, -log10(cast(greatest(256L - a.d0, 1L) as double))))"""
    return seen.union(levels.select("key", F.expr(walk).alias("value")))


def _score(order: int, total: int, distinct: int, ends: int):
    """A block's texts with the answers: words' counts and grams' log10 probabilities."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        kind = answers.column("kind").to_numpy()
        key, value = answers.column("key").to_numpy(), answers.column("value").to_numpy()
        count_of, logp_of = (Lookup(key[kind == k], value[kind == k]) for k in (WORD_KEY, GRAM_KEY))
        del kind, key, value, answers
        release()
        whole = total + 0.5 * (distinct + 1)
        end_base, end_known = float(np.log10((ends + 0.5) / whole)), int(ends > 0)
        parts = {n: [] for n in ("n_tokens", "n_known", "base_score", "score")}
        held_counts: dict[bytes, float] = {}
        for b in block.select(["text"]).to_batches(max_chunksize=300):
            split = [words_of(t) for t in b.column(0).to_pylist()]
            if len(held_counts) > 100_000:
                held_counts.clear()
            new = list(set().union(*split).difference(held_counts))
            held_counts.update(zip(new, count_of(word_keys(new)).tolist()))
            n = np.array([len(w) for w in split])
            flat = np.fromiter((held_counts[x] for w in split for x in w), np.float64, int(n.sum()))
            row = np.repeat(np.arange(len(split)), n)
            parts["n_tokens"].append(n + 1)
            parts["n_known"].append(np.bincount(row, flat > 0, len(split)).astype(np.int64) + end_known)
            parts["base_score"].append(np.bincount(row, np.log10((flat + 0.5) / whole), len(split)) + end_base)
            scores = np.zeros(len(split))
            for first, lot in _texts(split):
                for code, within in _lot_grams(lot, order, True):
                    scores[first : first + len(lot)] += np.bincount(within, logp_of(code), len(lot))
            parts["score"].append(scores)
        held = block.column("held_out")
        columns = [block.column("doc_id"), held, *(pa.array(np.concatenate(parts[n])) for n in ("n_tokens", "n_known"))]
        columns += [pa.array(np.full(block.num_rows, total, np.int64)), *(pa.array(np.concatenate(parts[n])) for n in ("base_score", "score"))]
        out = pa.Table.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        del count_of, logp_of, held_counts, block, columns
        release()
        return out

    return run


def lm_scores(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of docs(doc_id, text)."""
    held = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), "text", held.alias("held_out"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // block_bytes))
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(n)).cast("int")).repartition(int(n) * SPREAD, "block")
    asked = settle(blocked.groupBy("block").applyInArrow(_ask(order), "kind byte, key long, n long, block int"))
    words, edges, nodes = train(asked, order)
    total, distinct, ends = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.max(F.when(F.col("key") == END_KEY, F.col("n"))), F.lit(0))
    ).first()
    wanted = asked.filter(F.col("kind") == GRAM_KEY).select("key").distinct()
    model = settle(
        gram_scores(wanted, edges, nodes, order).select(F.lit(GRAM_KEY).cast("byte").alias("kind"), "key", "value")
        .union(words.select(F.lit(WORD_KEY).cast("byte"), "key", F.col("n").cast("double")))
    )
    answers = asked.join(model, ["kind", "key"], "left").select("block", "kind", "key", F.coalesce("value", F.lit(0.0)).alias("value"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(order, total, distinct, ends), schema)


def op2_ppm_scores(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"))


QUERIES, ORACLES = {"op2_ppm_scores": op2_ppm_scores}, {}
