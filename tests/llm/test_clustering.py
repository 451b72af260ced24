import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyveil.llm.clustering import clustered, integer_vectors, nearest, op13_sql, spread_pivots, squared
from tallyveil.llm.queries import op13_centroids

from ..conftest import SF

ROW = "vec_id long, embedding array<float>, cluster int"


def test_query_against_sql(spark, same_as_sql):
    same_as_sql(op13_centroids(spark, SF), op13_sql())


def test_bounds_never_change_an_assignment():
    rng = np.random.default_rng(3)
    x, c = rng.integers(-900, 900, (400, 5)), rng.integers(-900, 900, (9, 5))
    c[7] = c[2]
    x[:9] = c
    pivots = spread_pivots(x, 4)
    to = lambda y: np.sqrt(np.stack([squared(y, p) for p in pivots], axis=1))
    every = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    best, distance = nearest(x, to(x), c, to(c))
    assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def plain(rows, k, rounds, dim):
    kept = [(i, [int(np.floor(1024 * float(np.float32(c)))) for c in v]) for i, v, *_ in rows if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for _, v in kept:
            groups[near(v)[1]].append(v)
        centroids = [[sum(col) // len(g) for col in zip(*g)] if g else c for g, c in zip(groups, centroids)]
    found = [(i, *near(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    return sorted((repr(i), j, d, sum(e for _, e, m in found if m == j), total, hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, d, j in found)


def test_edge_rows_against_loops(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(i % 3, 0.4, 4)], 1) for i in range(70)]
    rows += [rows[0], rows[0], (3, [9.0, 9.0, 9.0, 9.0], 1), (None, [1.0, 1.0, 1.0, 1.0], 2), (None, [-1.0, 0.0, 1.0, 1.0], 2)]
    bad = [(90, None, 1), (91, [], 1), (92, [1.0] * 3, 1), (93, [1.0] * 5, 1), (94, [1.0, None, 1.0, 1.0], 1), (95, [1.0, float("nan"), 1.0, 1.0], 1), (96, [float("inf"), 1.0, 1.0, 1.0], 1)]
    df = spark.createDataFrame(rows + bad, ROW).repartition(5)
    got = sorted((repr(r.vec_id), *r[1:]) for r in clustered(df, dim=4, clusters=6, rounds=4).collect())
    assert got == plain(rows, 6, 4, 4)


def test_small_tables(spark):
    assert clustered(spark.createDataFrame([], ROW)).collect() == []
    two = spark.createDataFrame([(1, [0.5, 0.5], 1), (2, [0.25, 0.0], 1)], ROW)
    rows = clustered(two, dim=2).collect()
    assert sorted(r.cluster for r in rows) == [0, 1] and {r.inertia for r in rows} == {0}
    same = clustered(spark.createDataFrame([(i, [1.0, 2.0], 1) for i in range(20)], ROW), dim=2).collect()
    assert len(same) == 20 and {(r.cluster, r.distance) for r in same} == {(0, 0)}


def test_components_that_do_not_fit(spark):
    df = spark.createDataFrame([(1, [3e6, 0.0], 1)], ROW)
    with pytest.raises(Exception, match="passes"):
        integer_vectors(df, dim=2).agg(F.max("x")).collect()
