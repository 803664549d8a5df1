from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from martloom.llm import neighbours as N
from martloom.llm.catalogue import op9_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, size string, owners string"


def exact(rows, every, k=10):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, query in zip(ids, points):
        if i % every == 0:
            far = np.sqrt(((points - query) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, far)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(far[j])) for j in order]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_graph_is_whole_and_survives_storing():
    points = np.random.default_rng(0).normal(size=(1500, 16))
    graph = N.Graph.built(points)
    again = N.Graph.loaded(points, **graph.stored())
    right = 0
    for query in points[:100] + 0.01:
        found = graph.search(query, 10, 64)
        assert found == again.search(query, 10, 64)
        right += len({n for _, n in found} & set(np.argsort(((points - query) ** 2).sum(axis=1))[:10].tolist()))
    assert right >= 950
    assert N.Graph.built(points[:1]).search(points[0], 3, 8) == [(0.0, 0)] and N.Graph.built(points[:0]).search(points[0], 3, 8) == []


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    got, rows = by_query(op9_neighbours(spark, sf)), [(r.vec_id, r.embedding) for r in table.collect()]
    expected = exact(rows, 100)
    assert set(got) == set(expected) and all(len(v) == 10 for v in got.values())
    for q, found in got.items():
        scores = dict(expected[q])
        assert all(abs(scores[v] - s) < 1e-12 for v, s in found if v in scores)
        assert found == sorted(found, key=lambda x: (x[1], x[0]))
    assert sum(len({v for v, _ in got[q]} & {v for v, _ in expected[q]}) for q in got) >= 0.9 * 10 * len(got)


def test_small_shards_are_merged_and_blocks_are_whole(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(600)]
    table = spark.createDataFrame([(i, v, 0, "", "") for i, v in rows], SCHEMA)
    monkeypatch.setattr(N, "BLOCK_VALUES", 100)
    got, expected = by_query(N.nearest(table, F.col("vec_id") % 10 == 0, shard_rows=100)), exact(rows, 10)
    assert set(got) == set(expected)
    assert sum(len(set(got[q]) & set(expected[q])) for q in got) >= 0.97 * 10 * len(got)


def test_copies_ties_and_vectors_that_take_no_part(spark):
    one, two, nan = [1.0, 0.0], [0.0, 1.0], float("nan")
    rows = [(i, one) for i in range(40)] + [(100, two), (101, [0.0, -1.0]), (102, [nan, 1.0]), (103, None), (104, [0.0, 0.0]), (105, [None, 1.0])]
    rows += [(106, [float("inf"), 1.0]), (None, one), (200, [1.0, 2.0, 3.0]), (201, [1.0, 2.0, 4.0]), (0, one), (300, [])]
    table = spark.createDataFrame([(i, v, 0, "", "") for i, v in rows], SCHEMA)
    got = by_query(N.nearest(table, F.col("vec_id") % 100 == 0))
    assert got[0] == [(v, 0.0) for v in range(1, 11)]
    assert got[100] == [(v, 2**0.5) for v in range(10)]
    assert got[200] == [(201, 1.0)] and set(got) == {0, 100, 200}
    few = by_query(N.nearest(table.filter("vec_id in (0, 5, 101)"), F.col("vec_id") % 100 == 0))
    assert few == {0: [(5, 0.0), (101, 2**0.5)]}
    assert N.nearest(table.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_recall_on_full_shards(spark):
    points = np.random.default_rng(8).normal(size=(2 * N.SHARD_ROWS, 64)).astype(np.float32)
    table = spark.createDataFrame([(i, p) for i, p in enumerate(points.tolist())], "vec_id long, embedding array<float>")
    index = N.build(N.usable(table))
    assert index.count() == 2 and index.select(F.sum(F.size("owners"))).first()[0] == len(points)
    got = by_query(N.search(N.usable(table).filter("vec_id % 128 = 0"), index))
    expected = exact(list(enumerate(points)), 128)
    assert set(got) == set(expected) and len(got) == 128
    assert sum(len({v for v, _ in got[q]} & {v for v, _ in expected[q]}) for q in got) >= 0.95 * 10 * len(got)


def test_each_shard_is_a_partition_of_its_own(spark):
    points = np.random.default_rng(9).normal(size=(900, 4))
    table = spark.createDataFrame([(i, p) for i, p in enumerate(points.tolist())], SCHEMA.split(", label")[0])
    index = N.build(N.usable(table), shard_rows=100)
    files = [r.f for r in index.select(F.input_file_name().alias("f")).collect()]
    assert len(files) == len(set(files)) == 9
