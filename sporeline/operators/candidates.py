"""Pairs of sequences that may be alike, complete at every length.

Of two sequences that are alike, let u be the shorter (then the first). With identity t, u's aligned part holds at most
e = (1 - t) / t * length edits, so of e + 1 bits of u that don't overlap and lie in the part of u that is always aligned,
one stands unchanged in the other. Each sequence files its rarest such bits, by a count of all bits of the corpus in a
sketch of a fixed size: a dynamic programme finds the bits with the least total count among all choices that don't
overlap, so a flank that all sequences have in common is left out wherever the rest has room for e + 1 bits. Where that
room is too small for the longest bits, those of lengths between them and their half fill it. All sequences look under
their own bits. The sketch only weighs choices; any counts give all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.functions import seq as S
from sporeline.operators import graph

#: Lengths of bits. A sequence uses the longest that lets e + 1 bits stand side by side, and the next one of at most half of it.
MENU = (24, 16, 12, 8, 6, 5, 4, 3, 2, 1)
SHORTEST_HALF = 6
#: One length more, as bits of 12 bases of many sequences of just under 80 would meet by chance.
FINER = (24, 16, 14, *MENU[2:])
#: Lengths that a sequence takes as well if its bits are common, from its half to its longest ones.
BETWEEN = (20, 16, 14, 12, 10, 8)
#: Meetings of a bit, beside those that the sketch's error may feign, over which it is common.
COMMON = 8
#: Counters of the sketch for each length of bits, and the parts in which they are added up.
COUNTERS, CHUNKS = 1 << 18, 32
#: Cells of the dynamic programme at once.
CELLS = 2_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def edits(length: int, identity: float, most: int | None = None) -> int:
    """Edits that the aligned part of a sequence may have: ``most``, or what the identity allows."""
    return int((1 - identity) / identity * length + 1e-9) if most is None else most


def spared(length: int, coverage: float) -> int:
    """Bases at either end that may stand outside the aligned part."""
    return int((1 - coverage) * length + 1e-9)


def sizes(length: int, identity: float, coverage: float, most: int | None = None) -> tuple[int, ...]:
    """Lengths of the bits that a sequence files; (0,): none fits, it meets all."""
    room = (length - 2 * spared(length, coverage)) // (edits(length, identity, most) + 1)
    first = next((k for k in FINER if k <= room), 0)
    half = next((k for k in FINER if SHORTEST_HALF <= k <= first // 2), 0)
    return (first, half) if half else (first,)


def between(own: tuple[int, ...]) -> tuple[int, ...]:
    """Lengths between those of ``sizes``."""
    return tuple(k for k in BETWEEN if own[-1] < k < own[0])


def _codes(seq: bytes, k: int) -> np.ndarray:
    """A 64-bit hash for each bit of k bases."""
    n = len(seq) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if k == 0:
        return np.zeros(1, np.uint64)
    base = np.frombuffer(seq, np.uint8).astype(np.uint64)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = (out ^ base[i : i + n]) * _ODD
        out ^= out >> np.uint64(29)
    return out


def _lots(seqs: list[str]) -> Iterator[tuple[int, list[int], np.ndarray]]:
    """(length, places, bytes) of the sequences of a length, in lots of so many that their bits' tables stay small."""
    by: dict[tuple[int, int], list] = {}
    for i, s in enumerate(seqs):
        b = s.encode()
        by.setdefault((len(s), len(b)), []).append((i, b))
    for (length, size), lot in by.items():
        step = max(1, CELLS // 4 // max(1, size))
        for part in (lot[a : a + step] for a in range(0, len(lot), step)):
            yield length, [i for i, _ in part], np.frombuffer(b"".join(b for _, b in part), np.uint8).reshape(len(part), size)


def _codes_of(rows: np.ndarray, k: int) -> np.ndarray:
    """``_codes`` of each row."""
    n = rows.shape[1] - k + 1
    if n <= 0 or k == 0:
        return np.zeros((len(rows), 0 if n <= 0 else 1), np.uint64)
    base = rows.astype(np.uint64)
    out = np.full((len(rows), n), k, np.uint64)
    for i in range(k):
        out = (out ^ base[:, i : i + n]) * _ODD
        out ^= out >> np.uint64(29)
    return out


def _counter(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(40)).astype(np.int64) % COUNTERS


def _sketch(seqs: DataFrame, menu: list[int]) -> np.ndarray:
    """Counts of all bits of all sequences by their counter: a row of the table for each length of bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(menu), COUNTERS), np.int64)
        for batch in batches:
            for _, _, rows in _lots(batch.column(0).to_pylist()):
                for row, k in enumerate(menu):
                    total[row] += np.bincount(_counter(_codes_of(rows, k)).ravel(), minlength=COUNTERS)
        parts = np.split(total, CHUNKS, 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), pa.array([x.tobytes() for x in parts])], ["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
        return pa.table([table.column("part").slice(0, 1), pa.array([total.tobytes()])], ["part", "counts"])

    counted = seqs.select("seq").mapInArrow(count, "part int, counts binary").groupBy("part").applyInArrow(add, "part int, counts binary")
    rows = {r.part: np.frombuffer(r.counts, np.int64).reshape(len(menu), -1) for r in counted.collect()}
    return np.concatenate([rows[i] for i in range(CHUNKS)], 1) if rows else np.zeros((len(menu), COUNTERS), np.int64)


def rarest(costs: dict[int, np.ndarray], first: int, last: int, need: int) -> list[list[tuple[int, int]]]:
    """For each row of the cost tables (bit length: cost at each place), ``need`` bits (place, length) within [first, last)
    that don't overlap and have the least total cost."""
    some = next(iter(costs.values()))
    rows, width = len(some), last - first
    here = np.zeros((rows, width + 1))
    steps = []
    for _ in range(need):
        best, which = np.full((rows, width + 1), np.inf), np.zeros((rows, width + 1), np.uint8)
        for k, cost in costs.items():
            if k <= width:
                new = here[:, : width - k + 1] + cost[:, first : last - k + 1]
                np.copyto(which[:, k:], np.uint8(k), where=new < best[:, k:])
                np.minimum(best[:, k:], new, out=best[:, k:])
        here = np.minimum.accumulate(best, 1)
        steps.append((np.maximum.accumulate(np.where(best == here, np.arange(width + 1), 0), 1), which))
    out: list[list[tuple[int, int]]] = [[] for _ in range(rows)]
    at = np.full(rows, width)
    every = np.arange(rows)
    for places, which in reversed(steps):
        end = places[every, at]
        k = which[every, end].astype(np.int64)
        at = end - k
        for row, a, size in zip(out, (at + first).tolist(), k.tolist()):
            row.append((a, size))
    return out


def _chosen(rows: np.ndarray, own: tuple[int, ...], menu: list[int], counts: np.ndarray, first: int, last: int, need: int) -> list[list[tuple[int, int, int]]]:
    """(place, length, key) of each row's rarest bits. Where they are common even without what else falls on their counters,
    the lengths between are tried, too, and taken if their bits are less than half as common."""
    codes, costs = {}, {}
    for k in own:
        codes[k] = _codes_of(rows, k)
        costs[k] = counts[menu.index(k)][_counter(codes[k])].astype(np.float64)
    out = rarest(costs, first, last, need)
    more = between(own)
    if more:
        mean = {k: counts[menu.index(k)].sum() / COUNTERS for k in (*own, *more)}
        own_cost = lambda k, count: np.maximum(count - mean[k], 0) + mean[k] * COUNTERS / 4.0**k
        over = {k: own_cost(k, cost) for k, cost in costs.items()}
        paid = [sum(over[k][i, a] for a, k in bits) for i, bits in enumerate(out)]
        common = np.flatnonzero(np.array(paid) > need * (COMMON + 2 * mean[own[0]] ** 0.5))
        if len(common):
            over = {k: x[common] for k, x in over.items()}
            for k in more:
                codes[k] = np.zeros((len(rows), rows.shape[1] - k + 1), np.uint64)
                codes[k][common] = _codes_of(rows[common], k)
                over[k] = own_cost(k, counts[menu.index(k)][_counter(codes[k][common])])
            for at, (i, bits) in enumerate(zip(common.tolist(), rarest(over, first, last, need))):
                if sum(over[k][at, a] for a, k in bits) < paid[i] / 2:
                    out[i] = bits
    return [[(a, k, int(codes[k][i, a].view(np.int64))) for a, k in bits] for i, bits in enumerate(out)]


def _file(menu: list[int], table, identity: float, coverage: float, most: int | None):
    """(key, id, at, length) of each sequence's rarest bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        for batch in batches:
            own_ids = batch.column(0).to_pylist()
            keys, ids, places, bits = [], [], [], []
            for length, lot, rows in _lots(batch.column(1).to_pylist()):
                own = sizes(length, identity, coverage, most)
                if own == (0,):
                    keys += [0] * len(lot)
                    ids += [own_ids[i] for i in lot]
                    places += [0] * len(lot)
                    bits += [0] * len(lot)
                    continue
                need = edits(length, identity, most) + 1
                step = max(1, CELLS // (length * need))
                for a in range(0, len(lot), step):
                    spare = spared(length, coverage)
                    for i, chosen in enumerate(_chosen(rows[a : a + step], own, menu, counts, spare, length - spare, need)):
                        for at, k, key in chosen:
                            keys.append(key)
                            ids.append(own_ids[lot[a + i]])
                            places.append(at)
                            bits.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(places, pa.int32()), pa.array(bits, pa.int32())], ["key", "u_id", "u_at", "bit"])

    return run


#: Bits of the table of filed keys, and the parts in which it is made.
MARKS, SLICES = 1 << 28, 64


def _place(keys: np.ndarray) -> np.ndarray:
    """A key's bit in the table: from all of its own bits, as those of short ones differ little at the top."""
    return ((keys.view(np.uint64) * _ODD) >> np.uint64(36)).astype(np.int64)


def marks(filed: DataFrame) -> np.ndarray:
    """A table of fixed size with a bit for each key of filed(key): what has none there is filed by no sequence. Each slice of
    it is made by one task from distinct keys."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(_place(batch.column(0).to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(places // (MARKS // SLICES), pa.int64()), pa.array(places % (MARKS // SLICES), pa.int64())], ["slice", "at"])

    def written(table: pa.Table) -> pa.Table:
        own = np.zeros(MARKS // SLICES, bool)
        own[table.column("at").to_numpy()] = True
        return pa.table([table.column("slice").slice(0, 1), pa.array([np.packbits(own).tobytes()], pa.binary())], ["slice", "own"])

    out = np.zeros((SLICES, MARKS // SLICES // 8), np.uint8)
    made = filed.select("key").mapInArrow(placed, "slice long, at long").distinct().groupBy("slice").applyInArrow(written, "slice long, own binary")
    for r in made.toLocalIterator():
        out[r.slice] = np.frombuffer(r.own, np.uint8)
    return out.reshape(-1)


def _look(least: dict[int, int], filed=None):
    """(key, id, at) of all bits of a sequence, of the lengths that a sequence no longer than it files; with ``filed``, a broadcast
    of ``marks``, of those alone that stand there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if filed is None else filed.value
        for batch in batches:
            keys, ids, places = [], [], []
            own_ids = batch.column(0).to_numpy()
            for length, lot, rows in _lots(batch.column(1).to_pylist()):
                for k, shortest in least.items():
                    if length >= shortest:
                        codes = _codes_of(rows, k)
                        row, at = (x.ravel() for x in np.indices(codes.shape))
                        codes = codes.ravel()
                        if table is not None and k:
                            bit = _place(codes)
                            on = (table[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1) > 0
                            codes, row, at = codes[on], row[on], at[on]
                        keys.append(codes.view(np.int64))
                        ids.append(own_ids[np.array(lot)[row]])
                        places.append(at.astype(np.int32))
            join = lambda x, t: pa.array(np.concatenate(x) if x else np.zeros(0, t))
            yield pa.RecordBatch.from_arrays([join(keys, np.int64), join(ids, np.int64), join(places, np.int32)], ["key", "v_id", "v_at"])

    return run


def pairs(
    seqs: DataFrame, identity: float, coverage: float = 1.0, both_strands: bool = False, most: int | None = None, groups: DataFrame | None = None
) -> DataFrame:
    """(u, v, low, high, strand) of distinct seqs(seq): all pairs, u the shorter one, that can have identity ``identity``
    (over 0.5) with at least ``coverage`` of u aligned, and the diagonals between which their alignment runs.

    With coverage 1 end gaps are edits, too. ``most`` bounds the edits in place of the identity (with coverage 1). With both strands, '-' pairs the reverse complement of ``u`` with v (``u`` is
    given reversed then). With groups(seq, bucket) only sequences of a bucket meet. Null sequences are in no pair, and empty ones in those of ``most`` alone.
    """
    spark = seqs.sparkSession
    numbered = graph.settled(seqs.select("seq").filter("seq <> ''" if most is None else "seq is not null").distinct().withColumn("id", F.monotonically_increasing_id()))
    lengths = numbered.select(F.length("seq").alias("n")).distinct()
    menu_of = {r.n: sizes(r.n, identity, coverage, most) for r in lengths.orderBy("n").toLocalIterator()}
    least: dict[int, int] = {}
    for n, own in menu_of.items():
        for k in (*own, *between(own)):
            least[k] = min(least.get(k, n), n)
    if not least:
        return spark.createDataFrame([], "u string, v string, low int, high int, strand string")
    menu = sorted(least)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    even = numbered.select("id", "seq").repartition(tasks)
    table = spark.sparkContext.broadcast(_sketch(even, menu))
    asked = even.withColumn("strand", F.lit("+"))
    if both_strands:
        asked = asked.union(numbered.select("id", S.revcomp(F.col("seq")).alias("seq"), F.lit("-")).repartition(tasks))
    bound = F.expr(f"cast(floor({(1 - identity) / identity!r} * u_n + 1e-9) as int)") if most is None else F.lit(most)
    of = numbered.withColumn("bucket", F.lit(0)) if groups is None else graph.settled(numbered.join(groups.select("seq", "bucket").distinct(), "seq"))
    size = lambda side: of.select(F.col("id").alias(f"{side}_id"), F.length("seq").alias(f"{side}_n"), "bucket")
    found = None
    for strand in ["+", "-"] if both_strands else ["+"]:
        own = asked.filter(F.col("strand") == strand).select("id", "seq")
        filed = graph.settled(own.mapInArrow(_file(menu, table, identity, coverage, most), "key long, u_id long, u_at int, bit int"))
        # Bits of a length that no sequence files are not looked up at all.
        chosen = {r.bit for r in filed.select("bit").distinct().toLocalIterator()}
        filed = filed.drop("bit")
        there = spark.sparkContext.broadcast(marks(filed))
        looked = even.mapInArrow(_look({k: n for k, n in least.items() if k in chosen}, there), "key long, v_id long, v_at int")
        # The files' size says nothing of the bits', so neither side may be taken for small.
        met = filed.join(size("u"), "u_id").join(looked.join(size("v"), "v_id").hint("merge"), ["key", "bucket"])
        met = met.filter("u_n < v_n or (u_n = v_n and u_id < v_id)")
        if coverage >= 1:
            met = met.filter((F.col("v_n") - F.col("u_n") <= bound) & ((F.abs(F.col("v_at") - F.col("u_at")) <= bound) | (F.col("key") == 0)))
        shift = F.col("v_at") - F.col("u_at")
        every = F.col("key") == 0
        part = met.groupBy("u_id", "v_id", "u_n", "v_n").agg(
            F.min(F.when(every, -F.col("u_n")).otherwise(shift - bound)).alias("low"), F.max(F.when(every, F.col("v_n")).otherwise(shift + bound)).alias("high")
        )
        part = part.withColumn("strand", F.lit(strand))
        found = part if found is None else found.union(part)
    u = numbered.select(F.col("id").alias("u_id"), F.col("seq").alias("u"))
    v = numbered.select(F.col("id").alias("v_id"), F.col("seq").alias("v"))
    out = found.join(u, "u_id").join(v, "v_id")
    turned = F.when(F.col("strand") == "-", S.revcomp(F.col("u"))).otherwise(F.col("u"))
    return out.select(turned.alias("u"), "v", F.col("low").cast("int"), F.col("high").cast("int"), "strand")
