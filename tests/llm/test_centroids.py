from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from martloom.llm.centroids import Centroids, clustered

SCHEMA = "vec_id long, embedding array<float>, cluster string, x string"


def plain(rows, dimensions, k, rounds, scale=64, salt=1):
    """Every distance, in Python integers."""
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]

    def rank(row):
        return (row[0] is None, hashlib.sha256(f"{salt}:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])

    centroids = [v for _, v in sorted(kept, key=rank)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [[] for _ in centroids]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for c, vs in zip(centroids, own)]
    out = [(i, *nearest(v)) for i, v in kept]
    per = {n: sum(d for _, d, m in out if m == n) for n in range(len(centroids))}
    return sorted(
        (
            (i, n, d, per[n], sum(per.values()), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
            for i, d, n in out
        ),
        key=repr,
    )


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("spread", [2, 40, 1 << 24])
def test_search_finds_the_nearest_and_the_smaller_number(spread):
    rng = np.random.default_rng(spread)
    x = rng.integers(-spread, spread, (800, 64))
    centroids = np.concatenate([x[:20], x[:5], rng.integers(-spread, spread, (8, 64)), np.roll(x[:3], 1, axis=1)])
    number, distance = Centroids(centroids).nearest(x)
    every = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()


def test_whole_table_against_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = clustered(table)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert found(got) == plain(rows, 64, 16, 3)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rng = random.Random(3)
    vectors = [[rng.choice([-1.0, -0.01, 0.0, 0.5, 1.0]) for _ in range(3)] for _ in range(60)]
    rows = [(i % 25 if i % 9 else None, v) for i, v in enumerate(vectors)] * 2
    rows += [(90, None), (91, [1.0, None, 0.0]), (92, [1.0, float("nan"), 0.0]), (93, [float("inf"), 0.0, 0.0]), (94, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, "c", "x") for i, v in rows], SCHEMA)
    assert found(clustered(table, dimensions=3, clusters=5)) == plain(rows, 3, 5, 3)


def test_fewer_vectors_than_centroids_empty_centroids_and_no_rows(spark):
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [0.5, 0.5])]
    table = spark.createDataFrame([(i, v, None, None) for i, v in rows], SCHEMA)
    assert found(clustered(table, dimensions=2)) == plain(rows, 2, 16, 3)
    none = clustered(table.limit(0))
    assert none.collect() == [] and none.columns[0] == "vec_id"


def test_distances_beyond_64_bits_raise(spark):
    table = spark.createDataFrame([(1, [1e7] * 64, None, None), (2, [0.0] * 64, None, None)], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        clustered(table).collect()
