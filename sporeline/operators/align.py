"""Global alignment with affine gaps and cheaper ends, within a band of diagonals, for many pairs at a time.

The value of a cell is one integer that holds, from the top, the score, the matches, the aligned pairs of bases and, taken
off, the inner gap columns. All four add up along a path, so one maximum finds the best score, among those the most matches,
then the most aligned pairs, then the fewest gap columns, and no way back through the table is needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Scoring(NamedTuple):
    """The usual scores of amplicon clustering. A gap costs open + length * extend, less at either end."""

    match: int = 2
    mismatch: int = -4
    open: int = 20
    extend: int = 2
    end_open: int = 2
    end_extend: int = 1


#: Cells of the band that are held at once, few enough for a core's cache.
CELLS = 50_000


def _matrix(seqs: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(seqs), width), np.uint8)
    for i, s in enumerate(seqs):
        out[i, : len(s)] = np.frombuffer(s, np.uint8)
    return out


def _lot(us: list[bytes], vs: list[bytes], low: np.ndarray, high: np.ndarray, s: Scoring):
    """(score, matches, aligned, gaps) of pairs; low and high: the diagonals j - i that the path may use."""
    n, m = (np.array([len(x) for x in xs]) for xs in (us, vs))
    low, high = np.maximum(low, -n), np.minimum(high, m)
    low, high = np.minimum(low, np.minimum(0, m - n)), np.maximum(high, np.maximum(0, m - n))  # both corners
    width, rows = int((high - low).max()) + 1, int(n.max())
    bits = int((n + m).max()).bit_length() + 1
    worst = int((n + m).max()) * max(s.match, -s.mismatch, s.extend, s.end_extend) + 4 * max(s.open, s.end_open)
    kind = np.int64 if 3 * bits + worst.bit_length() < 60 else object  # integers of any size for very long reads
    unit = 1 << (3 * bits)
    yes, no, step = s.match * unit + (1 << 2 * bits) + (1 << bits), s.mismatch * unit + (1 << bits), s.extend * unit + 1
    never = -(1 << 61) if kind is np.int64 else -unit * (worst + 1) * 4
    end = lambda k: np.where(k > 0, -(s.end_open + s.end_extend * k), 0).astype(kind) * unit
    u = _matrix(us, rows)
    # v's bases by place in the band: row i compares u's base i - 1 with v's bases i + low - 1, ...
    v = np.zeros((len(vs), rows + width), np.uint8)
    for b, x in enumerate(vs):
        a = max(0, -int(low[b]))
        part = x[max(0, int(low[b])) : max(0, rows + width + int(low[b]))]
        v[b, a : a + len(part)] = np.frombuffer(part, np.uint8)[: rows + width - a]
    k = np.arange(width)
    j = low[:, None] + k  # of row 0
    outside = k > (high - low)[:, None]
    cell = np.where((j >= 0) & (j <= m[:, None]) & ~outside, end(np.maximum(j, 0)), never)
    drop = np.full(cell.shape, never, cell.dtype)
    slope = (k * step).astype(kind)
    ends = np.arange(len(us))

    def column(i: int) -> np.ndarray:
        """The value in v's last column, where row i has it."""
        at = m - i - low
        return np.where((at >= 0) & (at < width), cell[ends, np.clip(at, 0, width - 1)], never)

    best = column(0) + end(n)
    final = np.where(n == 0, column(0), never)
    if (n == 0).any():
        last = (cell + end(np.maximum(m[:, None] - j, 0))).max(1)
        final = np.where(n == 0, np.maximum(final, last), final)
    for i in range(1, rows + 1):
        j = j + 1
        same = u[:, i - 1 : i] == v[:, i - 1 : i - 1 + width]
        up = np.full_like(cell, never)
        if width > 1:
            np.maximum(cell[:, 1:] - (s.open * unit + step), drop[:, 1:] - step, out=up[:, :-1])
        cell = np.maximum(cell + np.where(same, yes, no), up)
        drop = up
        wrong = (j < 1) | (j > m[:, None]) | outside
        cell[wrong] = never
        drop[wrong] = never
        edge = (j == 0) & ~outside  # only u's bases so far
        if edge.any():
            cell = np.where(edge, end(np.full(1, i)), cell)
        if width > 1:
            along = np.maximum.accumulate(cell + slope, 1)[:, :-1] - slope[1:] - s.open * unit
            inner = cell[:, 1:]
            np.maximum(inner, along, out=inner, where=~wrong[:, 1:])
        best = np.where(i < n, np.maximum(best, column(i) + end(np.maximum(n - i, 0))), best)
        done = n == i
        if done.any():
            last = np.where((j <= m[:, None]) & (j >= 0) & ~outside, cell + end(np.maximum(m[:, None] - j, 0)), never).max(1)
            final = np.where(done, np.maximum(last, best), final)
    field = 1 << bits
    gaps = -final % field
    rest = (final + gaps) // field
    aligned, rest = rest % field, rest // field
    return tuple(np.array(x, np.int64) for x in (rest // field, rest % field, aligned, gaps))


def _lots(us: list[bytes], vs: list[bytes], low: np.ndarray, high: np.ndarray, scoring: Scoring) -> np.ndarray:
    """``align`` of the diagonals as they are: the pairs are taken in lots of like size."""
    n = np.array([len(x) for x in us], np.int64)
    band = np.maximum(high, 0) - np.minimum(low, 0) + 1 + np.abs(np.array([len(x) for x in vs], np.int64) - n)
    order = np.lexsort((band, n)).tolist()
    out = np.zeros((4, len(us)), np.int64)
    lot: list[int] = []
    widest = 0
    for x in [*order, None]:
        if lot and (x is None or max(widest, int(band[x])) * (len(lot) + 1) > CELLS):
            out[:, lot] = _lot([us[i] for i in lot], [vs[i] for i in lot], low[lot], high[lot], scoring)
            lot, widest = [], 0
        if x is not None:
            lot.append(x)
            widest = max(widest, int(band[x]))
    return out


#: Diagonals beside those of the corners that are tried first.
NEAR = 9


def align(us: list[bytes], vs: list[bytes], low: np.ndarray, high: np.ndarray, scoring: Scoring = Scoring()):
    """(score, matches, aligned, gaps) arrays, one for each pair.

    A band over twice as wide as one about the corners is aligned in that one first. What leaves it and comes back has a gap
    in either sequence, so many bases long that its score has a bound; where the narrow band's is above it, it is the best.
    """
    n, m = (np.array([len(x) for x in xs], np.int64) for xs in (us, vs))
    apart = m - n
    low, high = np.minimum(np.maximum(low, -n), np.minimum(apart, 0)), np.maximum(np.minimum(high, m), np.maximum(apart, 0))
    near_low, near_high = np.maximum(low, np.minimum(apart, 0) - NEAR), np.minimum(high, np.maximum(apart, 0) + NEAR)
    tried = high - low + 1 > 2 * (near_high - near_low + 1)
    near_low, near_high = np.where(tried, near_low, low), np.where(tried, near_high, high)
    out = _lots(us, vs, near_low, near_high, scoring)
    gap, base = min(scoring.open, scoring.end_open), min(scoring.extend, scoring.end_extend)
    # By the nearest diagonal outside: u's bases that stand alone, then v's.
    score = lambda own, other: scoring.match * (n - own) - 2 * gap - base * (own + other)
    never = np.iinfo(np.int64).min
    above = np.where(near_high < high, score(near_high + 1 - apart, near_high + 1), never)
    below = np.where(near_low > low, score(1 - near_low, 1 - near_low + apart), never)
    again = np.flatnonzero(tried & (out[0] <= np.maximum(above, below))).tolist()
    if again:
        out[:, again] = _lots([us[i] for i in again], [vs[i] for i in again], low[again], high[again], scoring)
    return out


#: Bases of the bits by which pairs are told apart before they are aligned, and the pairs that are looked at together.
GRAM, TOGETHER = 6, 512


def _grams(seqs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, gram) of all bits of GRAM bases; other letters than A, C, G and T share the numbers of these."""
    base = (np.frombuffer(b"".join(seqs) + bytes(GRAM), np.uint8) >> 1 & 3).astype(np.int64)
    total = len(base) - GRAM
    gram = np.zeros(total, np.int64)
    for i in range(GRAM):
        gram = gram * 4 + base[i : i + total]
    n = np.array([len(x) for x in seqs], np.int64)
    row = np.repeat(np.arange(len(seqs)), n)
    whole = np.arange(total) - (np.cumsum(n) - n)[row] <= n[row] - GRAM
    return row[whole], gram[whole]


def alike(us: list[bytes], vs: list[bytes], most: np.ndarray) -> np.ndarray:
    """Whether each pair may be ``most`` edits apart: an edit takes no more than GRAM of u's bits of GRAM bases, and the others
    stand in v."""
    out = np.zeros(len(us), bool)
    for a in range(0, len(us), TOGETHER):
        u, v = us[a : a + TOGETHER], vs[a : a + TOGETHER]
        there = np.zeros((len(u), 4**GRAM), bool)
        there[_grams(v)] = True
        row, gram = _grams(u)
        shared = np.bincount(row[there[row, gram]], minlength=len(u))
        out[a : a + TOGETHER] = shared >= np.array([len(x) for x in u]) - GRAM + 1 - GRAM * most[a : a + TOGETHER]
    return out


def aligned(pairs: DataFrame, scoring: Scoring = Scoring(), least: float | None = None) -> DataFrame:
    """pairs(u, v, low, high, ...) with score, matches, aligned, gaps. Nulls aren't allowed in the four. With ``least``, pairs may
    be left out of which no alignment has that identity by definition 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: i for i, name in enumerate(batch.schema.names)}
            us, vs = ([x.encode() for x in batch.column(at[c]).to_pylist()] for c in ("u", "v"))
            if least is not None:
                # All columns but matches are edits, and there are no more matches than bases.
                may = alike(us, vs, np.array([int((1 - least) / least * len(x) + 1e-9) for x in us], np.int64))
                batch = batch.filter(pa.array(may))
                us, vs = ([x for x, on in zip(xs, may) if on] for xs in (us, vs))
            low, high = (batch.column(at[c]).to_numpy().astype(np.int64) for c in ("low", "high"))
            found = align(us, vs, low, high, scoring)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x) for x in found)], [*batch.schema.names, "score", "matches", "aligned", "gaps"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields)
    return pairs.mapInArrow(run, f"{kinds}, score long, matches long, aligned long, gaps long")


def identity(definition: int) -> Column:
    """Of aligned(): 1: matches by all columns, 2: by the columns without end gaps."""
    columns = F.length("u") + F.length("v") - F.col("aligned") if definition == 1 else F.col("aligned") + F.col("gaps")
    return F.when(columns > 0, F.col("matches") / columns).otherwise(F.lit(0.0))


#: Scores of the alignment by which errors are counted. Gaps cost by length alone, and nothing at the ends.
ERROR_MATCH, ERROR_MISMATCH, ERROR_GAP = 5, -4, -8
_BASE = np.full(256, 4, np.uint8)
_BASE[[ord(c) for c in "ACGT"]] = range(4)


def _path_lot(us: list[bytes], vs: list[bytes], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    n, m = (np.array([len(x) for x in xs]) for xs in (us, vs))
    low, high = np.minimum(np.maximum(low, -n), np.minimum(0, m - n)), np.maximum(np.minimum(high, m), np.maximum(0, m - n))
    width, rows = int((high - low).max()) + 1, int(n.max())
    never = -(1 << 40)
    u = _matrix(us, rows)
    v = np.zeros((len(vs), rows + width), np.uint8)
    for b, x in enumerate(vs):
        a = max(0, -int(low[b]))
        part = x[max(0, int(low[b])) : max(0, rows + width + int(low[b]))]
        v[b, a : a + len(part)] = np.frombuffer(part, np.uint8)[: rows + width - a]
    k = np.arange(width)
    outside = k > (high - low)[:, None]
    j = low[:, None] + k
    cell = np.where((j >= 0) & (j <= m[:, None]) & ~outside, 0, never)
    every = np.arange(len(us))
    move = np.zeros((rows + 1, len(us), width), np.uint8)  # 0: both, 1: u's base alone, 2: v's base alone
    best, where = np.full(len(us), never), np.zeros((2, len(us)), np.int64)

    def keep(value: np.ndarray, i: int, at: np.ndarray) -> None:
        better = value > best
        best[better], where[0][better], where[1][better] = value[better], i, at[better]

    for i in range(rows + 1):
        if i:
            j = j + 1
            both = cell + np.where(u[:, i - 1 : i] == v[:, i - 1 : i - 1 + width], ERROR_MATCH, ERROR_MISMATCH)
            up = np.full_like(cell, never)
            up[:, :-1] = cell[:, 1:] + ERROR_GAP
            cell = np.maximum(both, up)
            cell = np.where(j == 0, 0, cell)
            cell[(j < 0) | (j > m[:, None]) | outside] = never
            along = np.maximum.accumulate(cell - ERROR_GAP * k, 1) + ERROR_GAP * k
            move[i] = np.where(along > cell, 2, np.where(cell == both, 0, 1))
            cell = np.where((j < 0) | (j > m[:, None]) | outside, never, along)
        at = m - i - low  # v's last column
        inside = (at >= 0) & (at < width) & (i <= n)
        keep(np.where(inside, cell[every, np.clip(at, 0, width - 1)], never), i, np.clip(at, 0, width - 1))
        last = np.where((n == i)[:, None], cell, never)
        first = last.argmax(1)
        keep(last[every, first], i, first)
    counts = np.zeros((len(us), 17), np.int64)
    i, at = where[0].copy(), where[1].copy()
    while True:
        j = i + low + at
        on = (i > 0) & (j > 0)
        if not on.any():
            return counts[:, :16]
        step = move[i, every, at]
        pair = on & (step == 0)
        a, b = _BASE[u[every, np.maximum(i - 1, 0)]], _BASE[v[every, np.clip(i - 1 + at, 0, rows + width - 1)]]
        np.add.at(counts, (every[pair], np.where((a < 4) & (b < 4), a * 4 + b, 16)[pair]), 1)
        i, at = i - (on & (step < 2)), at + (on & (step == 1)) - (on & (step == 2))


def transitions(us: list[bytes], vs: list[bytes], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each pair the 16 counts of u's base (A, C, G, T) above v's base in their alignment; gaps and other letters don't
    count."""
    out, order = np.zeros((len(us), 16), np.int64), np.argsort([len(x) for x in us], kind="stable").tolist()
    lot: list[int] = []
    cells = 0
    for x in [*order, None]:
        if lot and (x is None or cells > CELLS * 64):
            out[lot] = _path_lot([us[i] for i in lot], [vs[i] for i in lot], low[lot], high[lot])
            lot, cells = [], 0
        if x is not None:
            lot.append(x)
            cells += (len(us[x]) + 1) * (int(high[x]) - int(low[x]) + 1 + abs(len(us[x]) - len(vs[x])))
    return out


class Local(NamedTuple):
    """The usual scores of barcode calling."""

    match: int = 4
    mismatch: int = 13
    insertion: int = 7  # a base of the read that the tag lacks
    deletion: int = 7  # a base of the tag that the read lacks


def local(tags: list[bytes], reads: list[bytes], s: Local = Local()) -> np.ndarray:
    """(score, tag bases, stop) of the best local alignment of each tag with its read: the highest score, then the most tag
    bases, then the first end; stop is the place after it in the read. All pairs go through the table together."""
    width, rows = max(map(len, reads), default=0), max(map(len, tags), default=0)
    t, r = _matrix(tags, rows), _matrix(reads, width)
    unit = 1 << 20
    k = np.arange(width + 1)
    cell = np.zeros((len(tags), width + 1), np.int64)
    best, stop = np.zeros(len(tags), np.int64), np.zeros(len(tags), np.int64)
    for i in range(rows):
        same = (t[:, i : i + 1] == r) & (r > 0)
        new = np.zeros_like(cell)
        new[:, 1:] = cell[:, :-1] + np.where(same, s.match * unit, -s.mismatch * unit) + 1
        new[:, 1:][r == 0] = 0
        new = np.maximum(np.maximum(new, cell - s.deletion * unit + 1), 0)
        new = np.maximum(new, np.maximum.accumulate(new + s.insertion * unit * k, 1) - s.insertion * unit * k)
        new[new < unit] = 0
        new[:, 1:][r == 0] = 0
        new[t[:, i] == 0] = 0
        at = new.argmax(1)
        top = new[np.arange(len(tags)), at]
        better = (top > best) | ((top == best) & (top > 0) & (at < stop))
        best[better], stop[better] = top[better], at[better]
        cell = new
    return np.stack([best // unit, best % unit, stop], 1)
