"""Benchmark decontamination: containment search by size-partitioned MinHash sketches."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import bounded_batches, stored

SHINGLE = 5
CONTAINMENT = 0.8
# Text of test items handled in one pass over the documents; more items take more passes.
BLOCK_BYTES = 16 << 20
MATCHES = "array<struct<item_id:long,matched:long,shingles:long>>"
_WORD = re.compile(r"\w+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles_of(words: list[str], size: int) -> set[tuple[str, ...]]:
    """Distinct runs of ``size`` words; a shorter text is one run."""
    if len(words) <= size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size))))


def size_class(shingles: int) -> int:
    """Items are partitioned by number of shingles: 1, 2, 3-4, 5-8, 9-16 and so on."""
    return (shingles - 1).bit_length()


def sketch_length(partition: int, containment: float) -> int:
    """MinHash values needed in a partition so that none of its items can be missed.

    A document that contains the share ``containment`` of at most ``2**partition``
    shingles lacks fewer than this many, so it holds one of any so many of them.
    """
    return int((1 - containment) * (1 << partition) + 1e-9) + 1


class Index:
    """Sketches and shingles of one block of test items.

    An item's sketch is the bottom of its shingles in the order of one hash
    function (XXH64), as long as its size partition asks. Words of the items are
    numbered; a run of numbers is found by a rolling key and compared exactly.
    """

    def __init__(self, items: list[tuple[int | None, str | None]], shingle: int, containment: float) -> None:
        self.shingle, self.containment = shingle, containment
        self.words: dict[str, int] = {}
        self.items: list[tuple[int | None, set[tuple[int, ...]]]] = []
        sketches: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        keys: dict[int, set[int]] = defaultdict(set)
        for item_id, text in items:
            runs = shingles_of(words_of(text), shingle)
            if not runs:
                continue
            partition, at = size_class(len(runs)), len(self.items)
            by_hash = sorted(runs, key=lambda run: (xxhash.xxh64_intdigest(" ".join(run).encode()), run))
            numbers = [tuple(self.words.setdefault(word, len(self.words) + 1) for word in run) for run in by_hash]
            self.items.append((item_id, set(numbers)))
            length = len(numbers[0])
            run_keys = self._keys(np.array(numbers, np.uint64).T)
            keys[length].update(run_keys.tolist())
            for key in run_keys[: sketch_length(partition, containment)].tolist():
                sketches[length][key].append(at)
        self.sketches = {n: dict(s) for n, s in sketches.items()}
        self.sketch_keys = {n: np.array(sorted(s), np.uint64) for n, s in sketches.items()}
        self.keys = {n: np.array(sorted(s), np.uint64) for n, s in keys.items()}

    @staticmethod
    def _keys(columns: np.ndarray) -> np.ndarray:
        key = np.zeros(len(columns[0]), np.uint64)
        for column in columns:
            key = (key ^ column) * _FACTOR
            key ^= key >> np.uint64(29)
        return key

    def matches(self, text: str | None) -> list[dict]:
        """Test items of which a whole text contains the asked share of shingles."""
        words = words_of(text)
        numbers = np.fromiter((self.words.get(w, 0) for w in words), np.uint64, len(words))
        found = []
        for length, sketch in self.sketches.items():
            runs = len(numbers) - length + 1
            if runs < 1:
                continue
            known = numbers != 0
            start = np.flatnonzero(np.logical_and.reduce([known[i : i + runs] for i in range(length)]))
            if not len(start):
                continue
            keys = self._keys(np.stack([numbers[start + i] for i in range(length)]))
            met = _present(keys, self.sketch_keys[length])
            if not met.any():
                continue
            candidates = sorted({at for key in set(keys[met].tolist()) for at in sketch[key]})
            held = start[_present(keys, self.keys[length])]
            own = set(map(tuple, np.stack([numbers[held + i] for i in range(length)], axis=1).tolist()))
            for at in candidates:
                item_id, wanted = self.items[at]
                matched = len(wanted & own)
                if matched >= self.containment * len(wanted) - 1e-9:
                    found.append({"item_id": item_id, "matched": matched, "shingles": len(wanted)})
        return found


def _present(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.searchsorted(among, keys)
    at[at == len(among)] = 0
    return among[at] == keys


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The distinct test items in blocks of bounded text, each small enough to broadcast."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").dropna(subset=["text"]).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for block in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block) if n > 1 else items
        yield sorted(((r.item_id, r.text) for r in part.collect()), key=repr)


def matches(text: Column, shared: Broadcast, shingle: int = SHINGLE, containment: float = CONTAINMENT) -> Column:
    """Test items of a broadcast block that are contained in ``text``, an array of ``MATCHES``."""
    return _search(shared, shingle, containment)(text)


def _search(shared: Broadcast, shingle: int, containment: float):
    @F.pandas_udf(MATCHES)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(shared.value, shingle, containment)
        for texts in batches:
            yield pd.Series([index.matches(text) for text in texts])

    return search


def contaminated(
    documents: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, containment: float = CONTAINMENT
) -> DataFrame:
    """``doc_id``, ``item_id``, ``matched``, ``shingles``, ``containment`` per document and item it contains.

    An item is contained if at least the share ``containment`` of its distinct
    runs of ``shingle`` words occurs anywhere in the document's whole text; words
    are runs of letters, digits and underscores in lower case. An item of fewer
    words is one run of its own length. NULL and empty texts and items without
    words match nothing. Repeated items count once, repeated documents each get
    their rows, a NULL ``doc_id`` or ``item_id`` is returned as such. Other
    columns are not read; empty tables give an empty result.

    The documents are not shuffled: a block of items is broadcast to where they are.
    If there are more, what the one before found is written first, so that a single
    block is in memory at a time; every further block reads the documents again.
    """
    spark = bounded_batches(documents.sparkSession)
    texts, found, shared = documents.select("doc_id", "text"), [], None
    for block in _blocks(benchmark):
        if shared:
            found[-1] = stored(found[-1], "contained")
            shared.destroy()
        shared = spark.sparkContext.broadcast(block)
        found.append(texts.select("doc_id", F.explode(matches(F.col("text"), shared, shingle, containment)).alias("m")))
    if not found:
        found = [texts.limit(0).select("doc_id", F.explode(F.array().cast(MATCHES)).alias("m"))]
    return reduce(DataFrame.unionAll, found).select(
        "doc_id", "m.item_id", "m.matched", "m.shingles", (F.col("m.matched") / F.col("m.shingles")).alias("containment")
    )


def clean(
    documents: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, containment: float = CONTAINMENT
) -> DataFrame:
    """The documents that contain no test item, all their columns unchanged.

    As in :func:`contaminated`, one block of items is in memory at a time; the
    documents that pass a block are written before the next one.
    """
    spark, shared = bounded_batches(documents.sparkSession), None
    for block in _blocks(benchmark):
        if shared:
            documents = stored(documents, "uncontaminated")
            shared.destroy()
        shared = spark.sparkContext.broadcast(block)
        documents = documents.filter(F.size(matches(F.col("text"), shared, shingle, containment)) == 0)
    return documents
