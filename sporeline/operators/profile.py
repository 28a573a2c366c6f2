"""K9: regions found by profile hidden Markov models, in batches.

A profile's nodes have a match, an insert and a delete state. The best local path is found by Viterbi's rule: it enters at any
node with equal chance and leaves anywhere; scores are log odds, in bits, against equal bases, and inserted bases score
nothing themselves. All sequences of a batch and all nodes go through a position at once: a chain of deletes within a
position is a running maximum after the chain's cost is taken off. Where the path began is carried along, so no table is
kept. A search first takes scores alone, from which it has each path's last base; only around the ends of paths that score
enough, and as far back as such a path can reach, are beginnings carried along. Scores aren't calibrated to chance as an
E-value is; a least score is the caller's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.functions import seq as S

NEVER = -1e6
#: Bases of sequences that go through a profile at once; their scores at a position stay in a core's cache.
LOT = 200_000
_CODE = np.full(256, 4, np.uint8)
for _letters, _i in (("Aa", 0), ("Cc", 1), ("Gg", 2), ("TtUu", 3)):
    for _c in _letters:
        _CODE[ord(_c)] = _i


@dataclass
class Profile:
    """match: nodes x 4 log odds in bits; moves: nodes x 7, log2 of match to match, insert, delete, insert to match, insert, delete
    to match, delete, of the step that leaves a node."""

    name: str
    match: np.ndarray
    moves: np.ndarray

    @property
    def length(self) -> int:
        return len(self.match)


def parse(text: str) -> list[Profile]:
    """The DNA profiles of a text in the common ASCII format of save files: per node a line of match scores, one of insert
    scores and one of seven transitions, all negative natural logarithms, '*' for never."""
    out = []
    number = lambda x: NEVER if x == "*" else -float(x) / np.log(2)
    for block in text.split("\n//"):
        lines = [x.split() for x in block.splitlines() if x.strip()]
        head = next((i for i, x in enumerate(lines) if x[0] == "HMM"), None)
        if head is None:
            continue
        named = {x[0]: x[1] for x in lines[:head] if len(x) > 1}
        letters = lines[head][1:]
        if sorted(letters) not in (sorted("ACGT"), sorted("ACGU")):
            raise ValueError(f"profile {named.get('NAME')}: letters {letters}")
        order = [letters.index("U" if x == "T" and "U" in letters else x) for x in "ACGT"]
        rows = lines[head + 2 :]
        if rows and rows[0][0] == "COMPO":
            rows = rows[1:]
        rows = rows[2:]  # the inserts and moves before the first node
        match, moves = [], []
        for i in range(0, len(rows) - 2, 3):
            scores = [number(x) for x in rows[i][1:5]]
            match.append([scores[j] + 2.0 for j in order])
            moves.append([number(x) for x in rows[i + 2][:7]])
        if len(match) != int(named.get("LENG", len(match))):
            raise ValueError(f"profile {named.get('NAME')}: {len(match)} nodes of {named['LENG']}")
        out.append(Profile(named.get("NAME", ""), np.array(match), np.maximum(np.array(moves), NEVER)))
    return out


def of_consensus(name: str, consensus: str, agree: float = 0.94, gap: float = 0.01, extend: float = 0.25) -> Profile:
    """A profile that expects a sequence's bases with chance ``agree`` and opens and extends gaps with ``gap`` and ``extend``."""
    match = np.full((len(consensus), 4), np.log2((1 - agree) / 3 * 4))
    match[np.arange(len(consensus)), _CODE[np.frombuffer(consensus.encode(), np.uint8)]] = np.log2(agree * 4)
    return Profile(name, match, np.tile(np.log2([1 - 2 * gap, gap, gap, 1 - extend, extend, 1 - extend, extend]), (len(consensus), 1)))


def best_paths(profile: Profile, seqs: list[bytes]) -> list[tuple[float, int, int, int, int]]:
    """(score, first base, last base, first node, last node), from 1, of each sequence's best path; the first end of equals. A
    score of 0 or less without a path is (NEVER, 0, 0, 0, 0)."""
    nodes, width = profile.length, max(map(len, seqs), default=0)
    code = np.full((len(seqs), width), 5, np.uint8)
    for row, s in zip(code, seqs):
        row[: len(s)] = _CODE[np.frombuffer(s, np.uint8)]
    emit = np.concatenate([profile.match.T, np.full((2, nodes), 0.0)])
    emit[5] = NEVER
    mm, mi, md, im, ii, dm, dd = profile.moves.T
    enter = -np.log2(nodes)
    shape = (len(seqs), nodes)
    # The cost of a chain of deletes up to each node; where it can't go on, a step of NEVER.
    chain = np.concatenate([[0.0], np.cumsum(dd)])[:nodes]
    value = {x: np.full(shape, NEVER) for x in "MID"}
    # Where a path began: its first base and node as one number.
    begin = {x: np.zeros(shape, np.int64) for x in "MID"}
    best, found = np.full(len(seqs), NEVER), np.zeros((4, len(seqs)), np.int64)
    every, node = np.arange(len(seqs)), np.arange(nodes)
    for i in range(width):
        match, match_begin = np.full(shape, enter), np.tile(i * nodes + node, (len(seqs), 1))
        for x, move in (("M", mm), ("I", im), ("D", dm)):
            way = value[x][:, :-1] + move[:-1]
            better = way > match[:, 1:]
            np.copyto(match[:, 1:], way, where=better)
            np.copyto(match_begin[:, 1:], begin[x][:, :-1], where=better)
        match = np.maximum(match + emit[code[:, i]], NEVER)
        open_, longer = value["M"] + mi, value["I"] + ii
        insert = np.where((code[:, i] == 5)[:, None], NEVER, np.maximum(np.maximum(open_, longer), NEVER))
        insert_begin = np.where(open_ >= longer, begin["M"], begin["I"])
        lead = np.full(shape, NEVER)
        lead[:, 1:] = match[:, :-1] + md[:-1] - chain[1:]
        top = np.maximum.accumulate(lead, 1)
        source = np.maximum(np.maximum.accumulate(np.where(lead == top, node, 0), 1) - 1, 0)
        delete = np.maximum(top + chain, NEVER)
        delete_begin = np.take_along_axis(match_begin, source, 1)
        value, begin = {"M": match, "I": insert, "D": delete}, {"M": match_begin, "I": insert_begin, "D": delete_begin}
        last = match.argmax(1)
        now = match[every, last]
        better = now > best + 1e-9
        best[better] = now[better]
        first = match_begin[every, last]
        for k, x in enumerate((first // nodes + 1, np.full(len(seqs), i + 1), first % nodes + 1, last + 1)):
            found[k][better] = x[better]
    return [(float(b), *map(int, x)) for b, x in zip(best, found.T)]


def best_ends(profile: Profile, seqs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(scores, last bases) of ``best_paths``, without where the paths begin. All sums are those of ``best_paths``; its bounds
    of NEVER are left out, as what is below the cost of entering is never the best way on."""
    nodes, lengths = profile.length, np.fromiter(map(len, seqs), np.int64, len(seqs))
    width = int(lengths.max(initial=0))
    code = np.full((len(seqs), width), 5, np.uint8)
    code[np.arange(width) < lengths[:, None]] = _CODE[np.frombuffer(b"".join(seqs), np.uint8)]
    code = np.ascontiguousarray(code.T)
    emit = np.concatenate([profile.match.T, np.full((2, nodes), 0.0)])
    emit[5] = NEVER
    emit = np.ascontiguousarray(emit.T)
    mm, mi, md, im, ii, dm, dd = (x[:, None] for x in profile.moves.T)
    enter = -np.log2(nodes)
    chain = np.concatenate([[0.0], np.cumsum(dd)])[:nodes, None]
    match, insert, delete = (np.full((nodes, len(seqs)), NEVER) for _ in range(3))
    ways, other, longer = (np.empty_like(match) for _ in range(3))
    best, last = np.full(len(seqs), NEVER), np.zeros(len(seqs), np.int64)
    for i in range(width):
        ways[0] = enter
        np.add(match[:-1], mm[:-1], out=ways[1:])
        for value, move in ((insert, im), (delete, dm)):
            np.add(value[:-1], move[:-1], out=other[1:])
            np.maximum(ways[1:], other[1:], out=ways[1:])
        np.maximum(ways[1:], enter, out=ways[1:])
        np.add(match, mi, out=other)
        np.add(insert, ii, out=longer)
        np.maximum(other, longer, out=insert)
        np.take(emit, code[i], axis=1, out=match, mode="clip")
        match += ways
        delete[0] = NEVER
        np.add(match[:-1], md[:-1], out=delete[1:])
        delete[1:] -= chain[1:]
        np.maximum.accumulate(delete, 0, out=delete)
        delete += chain
        now = match.max(0)
        better = now > best + 1e-9
        np.copyto(best, now, where=better)
        last[better] = i + 1
    return best, last


def reach(profile: Profile, least: float) -> int | None:
    """Bases that a path of at least ``least`` bits may have: one a node, and what its matches leave for inserts. None: any."""
    spare = np.maximum(profile.match.max(1), 0.0).sum() - np.log2(profile.length) - least
    cost = -profile.moves[:, [1, 4]].max()
    return None if cost < 1e-3 or profile.moves.max() > 0 else profile.length + int(max(0.0, spare) / cost) + 2


def _found(profile: Profile, seqs: list[bytes], least: float) -> list[tuple[int, tuple[float, int, int, int, int]]]:
    """(number, best path) of the sequences whose best path has at least ``least`` bits."""
    scores, last = best_ends(profile, seqs)
    far = reach(profile, least)
    own = np.flatnonzero((scores >= least) & (last > 0)).tolist()
    begin = [0 if far is None else max(0, int(last[i]) - far) for i in own]
    paths = best_paths(profile, [seqs[i][a : last[i]] for i, a in zip(own, begin)]) if own else []
    return [(i, (score, first + a, end + a, *at)) for i, a, (score, first, end, *at) in zip(own, begin, paths)]


def hits(seqs: DataFrame, profiles: list[Profile], least: float = 10.0, both_strands: bool = False) -> DataFrame:
    """(id, strand, profile, score, start, end, node_from, node_to) of seqs(id, seq): each profile's best path, of at least
    ``least`` bits; places are those on the strand. Null and empty sequences have none."""
    rows = seqs.filter("seq <> ''").select("id", F.lit("+").alias("strand"), "seq")
    if both_strands:
        rows = rows.union(seqs.filter("seq <> ''").select("id", F.lit("-"), S.revcomp(F.col("seq"))))
    shared = seqs.sparkSession.sparkContext.broadcast(profiles)
    kinds = [seqs.schema["id"].dataType.simpleString(), "string", "string", "double", "int", "int", "int", "int"]
    names = ["id", "strand", "profile", "score", "start", "end", "node_from", "node_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.encode() for x in batch.column(2).to_pylist()]
            order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
            lots, size = [[]], 0
            for i in order:
                if lots[-1] and size + len(texts[i]) > LOT:
                    lots.append([])
                    size = 0
                lots[-1].append(i)
                size += len(texts[i])
            index, out = [], []
            for p in shared.value:
                for lot in lots:
                    for i, path in _found(p, [texts[i] for i in lot], least):
                        index.append(lot[i])
                        out.append((p.name, *path))
            at = pa.array(index, pa.int32())
            types = (pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *(pa.array([r[k] for r in out], t) for k, t in enumerate(types))], names)

    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
    return rows.select("id", "strand", "seq").mapInArrow(run, schema)


def regions(seqs: DataFrame, profiles: list[Profile], least: float = 10.0) -> DataFrame:
    """(id, strand, length, SSU, ITS1, S58, ITS2, LSU) of seqs(id, seq), ids unique: the strand on which the profiles SSU_end,
    S58_start, S58_end and LSU_start score the most in all, and the coordinates 'LABEL: a-b' on it (or a marker of what
    isn't found) that ``intervals.parse_region`` reads. Sequences without any hit have no row."""
    found = hits(seqs, profiles, least, both_strands=True)
    wide = found.groupBy("id", "strand").agg(
        F.sum("score").alias("total"), *[F.max_by(F.when(F.col("profile") == n, F.struct("start", "end")), F.when(F.col("profile") == n, F.col("score"))).alias(n) for n in ("SSU_end", "S58_start", "S58_end", "LSU_start")]
    )
    top = wide.groupBy("id").agg(F.max_by(F.struct("strand", "SSU_end", "S58_start", "S58_end", "LSU_start"), F.struct("total", F.expr("if(strand = '+', 1, 0)"))).alias("b"))
    rows = top.select("id", "b.*").join(seqs.select("id", F.length("seq").alias("length")), "id")
    text = lambda label, a, b, marker: F.when(a.isNotNull() & b.isNotNull() & (a <= b), F.format_string(f"{label}: %d-%d", a, b)).otherwise(F.lit(f"{label}: {marker}"))
    c = lambda n, f: F.col(f"{n}.{f}")
    return rows.select(
        "id", "strand", "length",
        text("SSU", F.when(c("SSU_end", "end").isNotNull(), F.lit(1)), c("SSU_end", "end"), "Not found").alias("SSU"),
        text("ITS1", c("SSU_end", "end") + 1, c("S58_start", "start") - 1, "Not found").alias("ITS1"),
        text("5.8S", c("S58_start", "start"), c("S58_end", "end"), "Not found").alias("S58"),
        text("ITS2", c("S58_end", "end") + 1, c("LSU_start", "start") - 1, "Not found").alias("ITS2"),
        text("LSU", c("LSU_start", "start"), F.when(c("LSU_start", "start").isNotNull(), F.col("length")), "Not found").alias("LSU"),
    )


def read_profiles(spark: SparkSession, path: str) -> list[Profile]:
    """All profiles of the files at a path; a profile is some kilobytes, and a set of them is a parameter of the search."""
    return [p for row in spark.read.text(path, wholetext=True).collect() for p in parse(row.value)]
