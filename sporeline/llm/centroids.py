"""Centroid clustering of integer vectors with exact results, by matrix products.

Squared distances are |x|^2 - 2 x.c + |c|^2, a block of vectors against all centroids in one float64 product. Components
are integers, so that is exact as long as no partial result reaches 2^53: each is at most dim * (max|x| + max|c|)^2. Rows
and centroids for which this bound doesn't hold are compared by integers instead (int64 below 2^63, else Python's own).
Sums are integers of any size. A round is one treeAggregate over the packed blocks, which are written once, so that all
rounds see the same rows and a lost executor costs a block's work.

What reaches the driver is k centroids, and for each of them a count and sums. The blocks' rows aren't shuffled, so vectors
that are all alike are no hot key.

Defined cases: a vector that is null, of another length, or has a null or non-finite component is left out; a null vec_id
is hashed as the word null and returned as null; repeated rows are vectors like others (starting vectors of one hash stand
in the order of their components, and each counts); fewer than k vectors give as many centroids; no vectors give no rows;
a distance or an inertia beyond a long is null; columns other than vec_id and the vector are dropped.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sporeline.llm.common import release, settle, table

DIM, K, ROUNDS, SCALE = 64, 40, 5, 256
#: Vectors of a packed block.
BLOCK = 4096
EXACT = 2.0**53
_LONG = 2**63


def _pack(dim: int, scale: int):
    """Blocks of vectors as int64 ids, and components floor(scale * x) in float64, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                values = np.floor(flat * scale)
                yield pa.RecordBatch.from_arrays([pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([values.tobytes()])], ["ids", "vectors"])

    return run


def _large(x: np.ndarray) -> np.ndarray:
    return np.abs(x).max(1, initial=0.0)


def squared(x: np.ndarray, whole: np.ndarray):
    """Squared distances of rows x (integers in float64) to centroids (Python integers): exact, as int64 where products are,
    else as objects."""
    dim = x.shape[1]
    centroids = whole.astype(np.float64)
    big_x, big_c = _large(x), _large(centroids)
    out = (x * x).sum(1)[:, None] - 2.0 * (x @ centroids.T) + (centroids * centroids).sum(1)[None, :]
    safe = dim * (big_x[:, None] + big_c[None, :]) ** 2 < EXACT
    if safe.all():
        return out.astype(np.int64)
    exact = np.empty(out.shape, object)
    exact[safe] = out[safe].astype(np.int64)
    most = dim * (big_x[:, None] + big_c[None, :]) ** 2 < float(_LONG) / 4
    for j in range(len(centroids)):
        rows = np.flatnonzero(~safe[:, j] & most[:, j])
        if len(rows):
            exact[rows, j] = ((x[rows].astype(np.int64) - whole[j].astype(np.int64)) ** 2).sum(1)
        rows = np.flatnonzero(~safe[:, j] & ~most[:, j])
        if len(rows):
            for i in rows.tolist():
                exact[i, j] = sum((int(v) - w) ** 2 for v, w in zip(x[i], whole[j]))
    return exact


def nearest(x: np.ndarray, centroids: np.ndarray):
    """(number of the nearest centroid, the smaller of equals; squared distance) of each row."""
    with np.errstate(over="ignore", invalid="ignore"):
        d = squared(x, centroids)
    # argmin of objects compares Python integers and takes the first, too.
    which = d.argmin(1).astype(np.int64) if len(x) else np.zeros(0, np.int64)
    return which, d[np.arange(len(x)), which]


def _summed(x: np.ndarray, which: np.ndarray, k: int):
    """Counts, and exact sums as Python integers, of the rows of each cluster."""
    counts = np.bincount(which, minlength=k)
    sums = np.zeros((k, x.shape[1]), object)
    if len(x) * max(1.0, float(np.abs(x).max(initial=0.0))) < EXACT:
        member = np.zeros((k, len(x)))
        member[which, np.arange(len(x))] = 1.0
        sums += (member @ x).astype(np.int64)
    else:
        for row, c in zip(x, which.tolist()):
            sums[c] += np.array([int(v) for v in row], object)
    return counts, sums


def _totals(blocks, centroids: np.ndarray, measure, depth: int = 2):
    """Adds measure(x, which, distance) -> (counts, values) of all packed blocks."""
    dim = centroids.shape[1]
    shared = blocks.context.broadcast(centroids)

    def add(total, block):
        x = np.frombuffer(block, np.float64).reshape(-1, dim)
        new = measure(x, *nearest(x, shared.value))
        return new if total is None else (total[0] + new[0], total[1] + new[1])

    def combine(a, b):
        return b if a is None else a if b is None else (a[0] + b[0], a[1] + b[1])

    found = blocks.treeAggregate(None, add, combine, depth)
    shared.unpersist()
    return found


def starts(vectors: DataFrame, k: int, seed: str, scale: int = SCALE) -> np.ndarray:
    """The k vectors of vectors(vec_id, v) with the least sha256 of '<seed>:<vec_id>', in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    rows = vectors.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([[math.floor(scale * float(x)) for x in r.v] for r in rows], object)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: str = "2") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of vectors(vec_id, embedding); see the contract
    of op12 in the module's query. k * dim numbers are the model, so k is bounded by its parameter alone."""
    kept = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").alias("v")).filter(F.col("v").isNotNull() & (F.size("v") == dim))
    kept = kept.filter(F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    packed = settle(kept.mapInArrow(_pack(dim, scale), "ids array<bigint>, vectors binary"))
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = starts(kept, k, seed, scale)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema)
    n = len(centroids)
    blocks = packed.select("vectors").rdd.map(lambda r: bytes(r[0]))
    for _ in range(rounds):
        counts, sums = _totals(blocks, centroids, lambda x, which, d: _summed(x, which, n))
        centroids = np.array([[int(s) // c for s in row] if c else old for c, row, old in zip(counts.tolist(), sums, centroids)], object)

    def inertias(x, which, distance):
        out = np.zeros(n, object)
        for c in np.unique(which).tolist():
            out[c] = sum(map(int, distance[which == c].tolist()))
        return np.bincount(which, minlength=n), out

    _, each = _totals(blocks, centroids, inertias)
    fits = lambda v: v if v < _LONG else None
    each, total = [int(v) for v in each], fits(sum(map(int, each)))
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(block, np.float64).reshape(-1, dim)
                which, distance = nearest(x, centroids)
                which = which.tolist()
                columns = [ids, which, [fits(int(d)) for d in distance.tolist()], [fits(each[c]) for c in which], [total] * len(ids), [marks[c] for c in which]]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [x.split()[0] for x in schema.split(", ")])
        release()

    return packed.mapInArrow(assign, schema)


def op12_centroid_clusters(spark, sf_dir):
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """The rounds one after another. The vectors are in a position-wise form for the sums and as lists for the products."""
    head = f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS x FROM embeddings
        WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
    n AS MATERIALIZED (SELECT *, list_inner_product(x, x) AS xx FROM v),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, 'null'))) - 1 AS c, x AS y FROM v ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, 'null')) LIMIT {K})"""
    parts = [head]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, x, min(struct_pack(d := xx - 2 * list_inner_product(x, y) + list_inner_product(y, y), c := c)) AS best
            FROM n, c{r} GROUP BY vec_id, x)""")
        if r < ROUNDS:
            parts.append(f"""s{r} AS MATERIALIZED (SELECT c, p, sum(t) AS s, count(*) AS m FROM (SELECT best.c AS c, unnest(range(1, {DIM + 1})) AS p, unnest(x)::HUGEINT AS t FROM a{r}) GROUP BY c, p),
                c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(z.y, c{r}.y) AS y FROM c{r} LEFT JOIN
                (SELECT c, list(((s - ((s % m) + m) % m) // m)::DOUBLE ORDER BY p) AS y FROM s{r} GROUP BY c) z USING (c))""")
    return f"""WITH {', '.join(parts)}
    SELECT vec_id, best.c::INT AS cluster, best.d::BIGINT AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
        (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(list_transform(y, lambda t: t::BIGINT::VARCHAR), ',')) AS centroid_sha256
    FROM a{ROUNDS} JOIN c{ROUNDS} ON c{ROUNDS}.c = best.c"""


QUERIES, ORACLES = {"op12_centroid_clusters": op12_centroid_clusters}, {"op12_centroid_clusters": _oracle()}
