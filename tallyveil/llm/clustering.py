"""Centroid clustering in integers, with a pivot table that spares distances (LAESA).

Every vector's distances to a few fixed pivots are computed and stored once.
In each round the difference of two pivot distances bounds a centroid's
distance from below, by the triangle inequality; a centroid whose bound passes
the best exact distance so far is out, the others get exact integer distances.
Bounds are rounded down by more than floats can err, so assignments are exact.

A round is one scan of the stored table: tasks pass on one sum for each
cluster, the driver sees k centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import staged

DIM = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
PIVOTS = 12
#: Vectors, chosen by a hash of the id, among which pivots are sought.
PIVOT_SAMPLE = 256
#: Largest size of an integer component: a squared distance of DIM of them fits 64 bits.
LARGEST = 1 << 27
#: Relative error that is granted to square roots and their differences.
SLACK = 1e-9
START = "3:"


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """id, x (integers) of the vectors with exactly dim components, none null or non-finite."""
    v = F.col(vector_col)
    whole = (F.size(v) == dim) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    floor = F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    fits = F.forall(floor, lambda c: F.abs(c) <= LARGEST)
    x = F.when(fits, floor).otherwise(F.raise_error(F.lit(f"a component passes {LARGEST} / {scale}")))
    return vectors.select(F.col(id_col).alias("id"), vector_col).filter(whole).select("id", x.cast("array<int>").alias("x"))


def _hashed(prefix: str) -> Column:
    return F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")), 256)


def _first(table: DataFrame, prefix: str, most: int, dim: int) -> np.ndarray:
    """The vectors with the smallest hashes of prefix and id; equal ids go by components, null ids come last."""
    rows = table.orderBy(_hashed(prefix).asc_nulls_last(), "x").select("x").limit(most).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64).reshape(len(rows), dim)


def spread_pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Rows of sample, each the farthest from those before it in the sum of distances; the first one starts."""
    if not len(sample):
        return sample
    chosen, total = [0], np.zeros(len(sample))
    while len(chosen) < min(most, len(sample)):
        total += np.sqrt(squared(sample, sample[chosen[-1]]))
        total[chosen] = -1
        chosen.append(int(total.argmax()))
    return sample[chosen]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances between rows of integers."""
    d = x.astype(np.int64) - y
    return np.einsum("...i,...i->...", d, d)


def nearest(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, centroid_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row (ties: the smaller) and its squared distance, both exact."""
    lower = np.zeros((len(x), len(centroids)))
    for p in range(to_pivots.shape[1]):
        a, b = to_pivots[:, p, None], centroid_pivots[None, :, p]
        np.maximum(lower, np.abs(a - b) - SLACK * (a + b), out=lower)
    best = lower.argmin(axis=1)
    distance = squared(x, centroids[best])
    guessed = best.copy()
    for c in range(len(centroids)):
        left = np.flatnonzero((lower[:, c] <= np.sqrt(distance) * (1 + SLACK)) & (guessed != c))
        d = squared(x[left], centroids[c])
        nearer = (d < distance[left]) | ((d == distance[left]) & (c < best[left]))
        best[left[nearer]], distance[left[nearer]] = c, d[nearer]
    return best, distance


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _with_pivots(table: DataFrame, pivots: np.ndarray) -> DataFrame:
    """table with d: distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column("x"), pivots.shape[1])
            d = np.sqrt(np.stack([squared(x, p) for p in pivots], axis=1))
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(pivots))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, pa.array(d.ravel()))], [*batch.schema.names, "d"])

    return table.mapInArrow(run, f"{_ddl(table)}, d array<double>")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _assigner(centroids: np.ndarray, pivots: np.ndarray):
    at = np.sqrt(np.stack([squared(centroids, p) for p in pivots], axis=1))

    def run(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = _rows(batch.column("x"), centroids.shape[1]).astype(np.int64)
        return x, *nearest(x, _rows(batch.column("d"), len(pivots)), centroids, at)

    return run


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Centroids after one round; those without vectors stay."""
    assign, (k, dim) = _assigner(centroids, pivots), centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dim), dtype=np.int64)
        for batch in batches:
            x, cluster, _ = assign(batch)
            for c in range(k):
                mine = cluster == c
                n[c] += mine.sum()
                sums[c] += x[mine].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(n), pa.array(sums.tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = table.select("x", "d").mapInArrow(run, "cluster int, n long, sums array<long>").filter("n > 0")
    total = F.sum(F.col("total").cast("decimal(38,0)"))
    rows = parts.select("cluster", "n", F.posexplode("sums").alias("at", "total")).groupBy("cluster", "at").agg(total.alias("total"), F.sum("n").alias("n")).collect()
    out = centroids.copy()
    for r in rows:
        out[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    return out


def clustered(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, dim: int = DIM, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """One row for each vector that `integer_vectors` keeps: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Centroids start as the vectors with the smallest SHA-256 of START and the
    id, and move `rounds` times to the floor of their vectors' mean. Vectors of
    another length, null ones, and those with null or non-finite components
    give no rows; repeated rows count each. Equal ids are told apart by their
    components, null ids start last. Fewer vectors than clusters make as many
    clusters as vectors; an empty table gives no rows. A component whose
    integer passes LARGEST stops the run, as distances would pass 64 bits.
    Other columns play no part.
    """
    plain = integer_vectors(vectors, id_col, vector_col, dim=dim, scale=scale)
    start, sample = _first(plain, START, clusters, dim), _first(plain, "pivot:", PIVOT_SAMPLE, dim)
    kind = vectors.schema[id_col].dataType.simpleString()
    if not len(start):
        empty = f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], empty)
    fixed = spread_pivots(sample, pivots)
    table = staged(_with_pivots(plain, fixed), "pivot-table")
    centroids = start
    for _ in range(rounds):
        after = moved(table, centroids, fixed)
        if (after == centroids).all():
            break
        centroids = after
    return _assigned(table, centroids, fixed, id_col)


def _assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray, id_col: str) -> DataFrame:
    assign = _assigner(centroids, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, distance = assign(batch)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cluster, pa.int32()), pa.array(distance)], ["id", "cluster", "distance"])

    kind = table.schema["id"].dataType.simpleString()
    out = staged(table.select("id", "x", "d").mapInArrow(run, f"id {kind}, cluster int, distance long"), "clusters")
    sums = {r["cluster"]: int(r["total"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    facts = [(c, s, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sorted(sums.items())]
    per_cluster = table.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    both = out.join(F.broadcast(per_cluster), "cluster")  # one row for each of the k clusters
    return both.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_sql(dim: int = DIM, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same rounds, written out one after the other."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT r, min({{'d': d, 'k': k}}) AS best FROM (SELECT r, k, CAST(sum((v - c) * (v - c)) AS BIGINT) AS d FROM u JOIN f{r} USING (i) GROUP BY r, k) GROUP BY r),
m{r} AS (SELECT k, i, CAST((s - ((s % n + n) % n)) // n AS BIGINT) AS c FROM (SELECT best.k AS k, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM a{r} JOIN u USING (r) GROUP BY ALL)),
f{r + 1} AS MATERIALIZED (SELECT k, i, coalesce(m{r}.c, f{r}.c) AS c FROM f{r} LEFT JOIN m{r} USING (k, i))""")
    return f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
           WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
u AS MATERIALIZED (SELECT r, unnest(range({dim})) AS i, unnest(x) AS v FROM v),
c AS (SELECT row_number() OVER (ORDER BY sha256('{START}' || vec_id) NULLS LAST, x) - 1 AS k, x FROM v),
f0 AS MATERIALIZED (SELECT k, unnest(range({dim})) AS i, unnest(x) AS c FROM c WHERE k < {clusters}),{",".join(steps)},
h AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY i)) AS digest FROM f{rounds} GROUP BY k)
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN h ON h.k = best.k
"""
