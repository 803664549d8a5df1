"""Approximate nearest neighbours: one navigable small-world graph per shard, results merged."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.shared import bounded_batches, stored
from martloom.session import work_dir

# Distinct vectors of a shard, on average; a shard is one row of the stored index.
SHARD_ROWS = 8192
# With these, a full shard of 8,192 random 64-dimensional vectors answers with a recall of 0.97.
LINKS = 20
BUILD_WIDTH = 80
SEARCH_WIDTH = 96
K = 10
# Values of the query vectors that are broadcast in one block; one block is held at a time.
BLOCK_VALUES = 4 << 20
INDEX = "size int, shard long, entry int, levels binary, tops binary, links binary, vectors binary, owners array<array<long>>"
HITS = "query_id long, vec_id long, score double"


class Graph:
    """Hierarchical navigable small world over the rows of a float64 array.

    Each level is a flat array of neighbour numbers, ``width`` places per node and
    -1 where free. A node's highest level is drawn with halving chances of
    1/``links``; level 0 has twice the links.
    """

    def __init__(self, vectors: np.ndarray, links: int = LINKS) -> None:
        self.vectors, self.links = vectors, links
        self.near, self.tops, self.slots = [], np.zeros(0, np.int8), []
        self.entry = -1
        self.seen, self.mark = np.zeros(len(vectors), np.int64), 0

    @classmethod
    def built(cls, vectors: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 5) -> Graph:
        graph, n = cls(vectors, links), len(vectors)
        draw = np.random.default_rng(seed).random(n)
        graph.tops = np.minimum(-np.log(np.maximum(draw, 1e-12)) / np.log(links), 15).astype(np.int8)
        graph._lay()
        for node in range(n):
            graph._insert(node, width)
        return graph

    def _lay(self) -> None:
        """Free places for every level; ``slots`` gives a node's row in the levels above 0."""
        self.near, self.slots = [], []
        for level in range(int(self.tops.max(initial=0)) + 1):
            own = np.flatnonzero(self.tops >= level)
            slot = np.full(len(self.tops), -1, np.int32)
            slot[own] = np.arange(len(own))
            self.slots.append(slot)
            self.near.append(np.full((len(own), self.links * (1 + (level == 0))), -1, np.int32))

    def _distances(self, query: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        apart = self.vectors[nodes] - query
        return np.einsum("ij,ij->i", apart, apart)

    def _neighbours(self, node: int, level: int) -> np.ndarray:
        row = self.near[level][self.slots[level][node]]
        return row[row >= 0]

    def _walk(self, query: np.ndarray, start: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """The ``width`` nearest nodes found from ``start``, nearest first."""
        self.mark += 1
        mark, seen = self.mark, self.seen
        seen[[n for _, n in start]] = mark
        open_, best = list(start), [(-d, n) for d, n in start]
        open_.sort()
        best.sort()
        while open_:
            distance, node = heappop(open_)
            if len(best) >= width and distance > -best[0][0]:
                break
            near = self._neighbours(node, level)
            near = near[seen[near] != mark]
            if not len(near):
                continue
            seen[near] = mark
            distances = self._distances(query, near)
            if len(best) >= width:
                good = distances < -best[0][0]
                near, distances = near[good], distances[good]
            for d, n in zip(distances.tolist(), near.tolist()):
                if len(best) < width:
                    heappush(best, (-d, n))
                elif d < -best[0][0]:
                    heapreplace(best, (-d, n))
                else:
                    continue
                heappush(open_, (d, n))
        return sorted((-d, n) for d, n in best)

    def _spread(self, nodes: np.ndarray, distances: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` of the nodes, nearest first, each nearer to the centre than to those chosen before.

        Places that are left over go to the nearest of the rest.
        """
        order = np.lexsort((nodes, distances))
        nodes, distances = nodes[order], distances[order]
        if len(nodes) <= most:
            return nodes
        points = self.vectors[nodes]
        squares = np.einsum("ij,ij->i", points, points)
        apart = squares[:, None] + squares[None, :] - 2 * points @ points.T
        blocked, chosen = np.zeros(len(nodes), bool), []
        for i in range(len(nodes)):
            if not blocked[i]:
                chosen.append(i)
                if len(chosen) == most:
                    break
                blocked |= apart[i] < distances
        if len(chosen) < most:
            rest = np.setdiff1d(np.arange(len(nodes)), chosen)
            chosen = sorted([*chosen, *rest[: most - len(chosen)].tolist()])
        return nodes[chosen]

    def _connect(self, node: int, found: list[tuple[float, int]], level: int) -> None:
        near, slots = self.near[level], self.slots[level]
        width = near.shape[1]
        nodes, distances = np.array([n for _, n in found], np.int32), np.array([d for d, _ in found])
        chosen = self._spread(nodes, distances, self.links)
        near[slots[node], : len(chosen)] = chosen
        for other in chosen.tolist():
            row = near[slots[other]]
            free = np.flatnonzero(row < 0)
            if len(free):
                row[free[0]] = node
                continue
            all_ = np.append(row, np.int32(node))
            kept = self._spread(all_, self._distances(self.vectors[other], all_), width)
            row[:] = -1
            row[: len(kept)] = kept

    def _insert(self, node: int, width: int) -> None:
        top, query = int(self.tops[node]), self.vectors[node]
        if self.entry < 0:
            self.entry = node
            return
        highest = int(self.tops[self.entry])
        at = [(float(self._distances(query, np.array([self.entry]))[0]), self.entry)]
        for level in range(highest, top, -1):
            at = self._walk(query, at, 1, level)
        for level in range(min(top, highest), -1, -1):
            at = self._walk(query, at, width, level)
            self._connect(node, at, level)
        if top > highest:
            self.entry = node

    def search(self, query: np.ndarray, k: int, width: int) -> list[tuple[float, int]]:
        """About the ``k`` nearest rows as squared distance and number, nearest first."""
        if self.entry < 0:
            return []
        at = [(float(self._distances(query, np.array([self.entry]))[0]), self.entry)]
        for level in range(int(self.tops[self.entry]), 0, -1):
            at = self._walk(query, at, 1, level)
        return self._walk(query, at, max(width, k), 0)[:k]

    def stored(self) -> dict:
        flat = b"".join(level.tobytes() for level in self.near)
        shapes = np.array([level.shape for level in self.near], np.int64)
        return {"entry": self.entry, "levels": shapes.tobytes(), "tops": self.tops.tobytes(), "links": flat}

    @classmethod
    def loaded(cls, vectors: np.ndarray, entry: int, levels: bytes, tops: bytes, links: bytes) -> Graph:
        graph = cls(vectors)
        graph.entry, graph.tops = entry, np.frombuffer(tops, np.int8)
        graph._lay()
        flat, at = np.frombuffer(links, np.int32), 0
        graph.near = []
        for rows, width in np.frombuffer(levels, np.int64).reshape(-1, 2).tolist():
            graph.near.append(flat[at : at + rows * width].reshape(rows, width))
            at += rows * width
        return graph


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``embedding`` as doubles, of the rows whose vector takes part."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    fit = vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)
    return embeddings.filter(fit & F.col("vec_id").isNotNull()).select("vec_id", vector.alias("embedding"))


def distinct_vectors(vectors: DataFrame, k: int = K) -> DataFrame:
    """Each distinct vector with its ``k + 1`` smallest numbers: no answer of ``k`` needs more of them.

    Rows beyond that are dropped in each task before the shuffle, so that a vector
    that very many rows share arrives as a few rows per task.
    """
    numbered = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    first = vectors.distinct().withColumn("n", numbered).filter(F.col("n") <= k + 1)
    return first.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("owners"))


def build(vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The stored index: a row per shard with its graph as flat arrays, its vectors and their numbers.

    Vectors are dealt to shards by hash, those of different length to different
    shards; every distinct vector is in one. Each shard number is a partition of its own.
    """
    unique = stored(distinct_vectors(vectors, k), "distinct-vectors")
    shards = max(1, -(-unique.count() // shard_rows))
    dealt = unique.withColumn("size", F.size("embedding")).withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)))

    def graph(rows: pd.DataFrame) -> pd.DataFrame:
        points = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
        order = np.lexsort(points.T[::-1])
        points, owners = points[order], rows["owners"].to_numpy()[order]
        built = Graph.built(points).stored()
        size, shard = int(rows["size"].iloc[0]), int(rows["shard"].iloc[0])
        return pd.DataFrame([built | {"size": size, "shard": shard, "vectors": points.tobytes(), "owners": [list(map(int, o)) for o in owners]}])[
            ["size", "shard", "entry", "levels", "tops", "links", "vectors", "owners"]
        ]

    def graphs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A graph per length of the vectors, which come sorted by it."""
        held: list[pd.DataFrame] = []
        for batch in batches:
            for size, rows in batch.groupby("size"):
                if held and held[0]["size"].iloc[0] != size:
                    yield graph(pd.concat(held))
                    held = []
                held.append(rows)
        if held:
            yield graph(pd.concat(held))

    # By number, so that two shards never share a task, as they would by hash.
    own = dealt.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("size")
    return stored(own.mapInPandas(graphs, INDEX), "graphs")


def _blocks(queries: DataFrame) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """The queries in blocks of bounded size: per length of vector the numbers, and the vectors as rows."""
    total = queries.agg(F.sum(F.size("embedding"))).first()[0] or 0
    n = -(-total // BLOCK_VALUES)
    block = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(max(n, 1))).cast("int")
    dealt = stored(queries.withColumn("block", block).repartitionById(max(n, 1), "block"), "queries")
    for number in range(n):
        part = dealt.filter(F.col("block") == number).toArrow()
        ids, vectors = part["vec_id"].to_numpy(), part["embedding"].combine_chunks()
        sizes, flat = vectors.value_lengths().to_numpy(zero_copy_only=False), vectors.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        yield [
            (ids[sizes == size], flat[starts[sizes == size][:, None] + np.arange(size)]) for size in np.unique(sizes).tolist()
        ]


def _ask(shared, k: int, width: int):
    """Asks every shard of a task for a block of queries, and returns the task's best ``k`` per query."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for rows in batches:
            for row in rows.itertuples(index=False):
                points = np.frombuffer(row.vectors, np.float64).reshape(-1, row.size)
                graph = Graph.loaded(points, row.entry, row.levels, row.tops, row.links)
                for ids, queries in shared.value:
                    if queries.shape[1] != row.size:
                        continue
                    for at, (query_id, query) in enumerate(zip(ids.tolist(), queries)):
                        found = graph.search(query, k + 1, width)
                        own = {(float(np.sqrt(((points[n] - query) ** 2).sum())), int(v)) for _, n in found for v in row.owners[n] if v != query_id}
                        key = (row.size, at)
                        best[key] = sorted(own.union(best.get(key, ())))[:k]
        for ids, queries in shared.value:
            hits = [(i, v, d) for at, i in enumerate(ids.tolist()) for d, v in best.get((queries.shape[1], at), ())]
            yield pd.DataFrame(hits, columns=["query_id", "vec_id", "score"])

    return ask


def search(queries: DataFrame, index: DataFrame, k: int = K, width: int = SEARCH_WIDTH) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the nearest found in all shards, ties to the smaller number.

    Block by block, the queries are broadcast and ask every shard where it lies; the
    answers are written before the next block is fetched. Each task answers with its
    best ``k`` per query, and these are merged. The work is queries times shards.
    """
    spark, paths = index.sparkSession, []
    for block in _blocks(queries):
        shared = spark.sparkContext.broadcast(block)
        paths.append(work_dir(spark, "hits"))
        index.mapInPandas(_ask(shared, k, width), HITS).write.parquet(paths[-1])
        shared.destroy()
    found = spark.read.schema(HITS).parquet(*paths) if paths else spark.createDataFrame([], HITS)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, chosen: Column, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` nearest found of every row that is ``chosen``, among all rows but itself.

    Distance is Euclidean, of the original vectors in double precision. Fewer
    than ``k`` others give as many rows. Vectors that are NULL, zero or hold a NULL
    or non-finite value take no part, nor do rows without ``vec_id``; vectors of
    different length are not compared. Equal vectors are all candidates. Rows with
    the same ``vec_id`` are one row with several vectors, none of which answers
    another, and are ranked together. Other columns are not read; an empty table
    gives an empty result.
    """
    bounded_batches(embeddings.sparkSession)
    vectors = usable(embeddings)
    return search(vectors.filter(chosen), build(vectors, k, shard_rows), k)
