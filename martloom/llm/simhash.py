"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.components import components
from martloom.llm.shared import bounded_batches, stored
from martloom.operators.sizing import broadcast_if_small

BITS = 64
SHINGLE = 3
MAX_BITS = 2
SEED = 42
_BLOCK = 1 << 13


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text as a signed 64-bit number.

    Letters A-Z are lowered, words are what ASCII white space separates. Every
    occurrence of a run of ``shingle`` words counts, a shorter text counts as
    one run, and a text without words, or none at all, has fingerprint 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        lengths = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(lengths + 1) - 1
        first, last = (ends - lengths)[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last)), np.uint64, len(first))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        octets = hashes[at : at + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """``fingerprint_of`` as a column, in Arrow batches."""

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(text, shingle) for text in texts], dtype="int64")

    return fingerprints(text)


def covering_masks(radius: int) -> list[int]:
    """Bit masks such that any two words within ``radius`` bits agree on one of them.

    Bit ``i`` is given a vector ``f(i)`` of ``radius + 1`` bits. The mask of a
    non-zero vector ``v`` keeps the bits whose ``f(i)`` has an odd product with
    ``v``. The vectors of at most ``radius`` differing bits cannot span the whole
    space, so some ``v`` is orthogonal to all of them and its mask keeps none of
    the bits that differ. Handing the vectors out in turn keeps over half the
    bits in every mask.
    """
    vectors = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(BITS) if ((1 + i % vectors) & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _flips(mask: int, most: int) -> list[int]:
    """All changes of at most ``most`` bits outside the mask."""
    free = [1 << i for i in range(BITS) if not mask >> i & 1]
    return [_signed(sum(c)) for k in range(most + 1) for c in combinations(free, k)]


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``a``, ``b`` that connect the fingerprints as all pairs within ``max_bits`` do.

    ``fingerprints`` has one distinct long ``fp`` per row. A fingerprint is hashed
    into one table per covering mask; only those that share a bucket go on. Inside
    a bucket nothing is paired: each fingerprint names the words within
    ``(max_bits + 1) // 2`` changes of the bits that the mask leaves open, and those
    that name the same word meet. Two that do so by at most half of ``max_bits``
    changes each are within ``max_bits``; for odd ``max_bits`` the last bit is
    settled by parity. Few fingerprints can name the same word (65 for 2 bits), so
    the work grows in proportion to a bucket, however large.
    """
    half, reach = max_bits // 2, (max_bits + 1) // 2
    masks = covering_masks(max_bits)
    tables = F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("kept")) for v, m in enumerate(masks)])
    hashed = fingerprints.select("fp", F.explode(tables).alias("t")).select("fp", "t.v", "t.kept")
    crowded = hashed.groupBy("v", "kept").agg(F.count("*").alias("n")).filter("n > 1").select("v", "kept")
    near = hashed.join(crowded, ["v", "kept"])
    flips = [F.array(*[F.lit(f) for f in _flips(m, reach)]) for m in masks]
    mine = F.element_at(F.array(*flips), F.col("v") + 1)
    named = near.select("fp", F.explode(mine).alias("flip")).select(
        F.col("fp").bitwiseXOR(F.col("flip")).alias("word"), "fp", F.bit_count("flip").alias("changes")
    )
    members = F.array_sort(F.collect_set(F.struct("fp", "changes")))
    met = named.groupBy("word").agg(members.alias("members")).filter(F.size("members") > 1)
    inner = F.filter("members", lambda m: m["changes"] <= half)
    stars = [(inner, inner)]
    if reach > half:
        even = F.filter("members", lambda m: F.bit_count(m["fp"]) % 2 == 0)
        odd = F.filter("members", lambda m: F.bit_count(m["fp"]) % 2 == 1)
        stars += [(even, odd), (odd, even)]
    hubs = [met.select(F.get(hub, F.lit(0))["fp"].alias("a"), F.explode(rest["fp"]).alias("b")) for hub, rest in stars]
    return reduce(DataFrame.union, hubs).filter(F.col("a") != F.col("b")).distinct()


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Group documents whose fingerprints are linked, directly or through others.

    ``documents`` needs ``doc_id`` and ``text``. Returns ``doc_id``,
    ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the smallest
    ``doc_id`` of the group, one row per row of the input.

    NULL and empty texts have fingerprint 0 and are linked like any others.
    Repeated rows stay. A NULL ``doc_id`` is grouped but never names a group; a
    group of such rows alone has a NULL ``component_id``. Other columns are not
    read. An empty table gives an empty result.
    """
    bounded_batches(documents.sparkSession)
    prints = stored(documents.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")), "fingerprints")
    groups = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "fingerprint-groups")
    linked = components(links(groups.select("fp"), max_bits)).select(F.col("node").alias("fp"), "root")
    members = groups.join(linked, "fp")
    firsts = members.groupBy("root").agg(F.min("first_doc").alias("component"))
    named = members.join(firsts, "root").select("fp", "component")
    # Written, so that both sides of the last join come straight from a shuffle and
    # adaptive execution can split the rows of a frequent fingerprint.
    names = stored(groups.join(named, "fp", "left").select("fp", F.coalesce("component", "first_doc").alias("component_id")), "components")
    return prints.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``documents`` without near-duplicates: of each group the document of the smallest ``doc_id`` stays.

    Where several rows have that ``doc_id``, the one that stays is among those of
    the group: the smallest by fingerprint, then by a hash of all columns, so that
    rows that still tie are equal. A row of the same ``doc_id`` in another group is
    judged there. Rows whose ``doc_id`` is NULL cannot be named by a group and stay
    as they are. All columns are kept, whatever their names.

    Only rows whose ``doc_id`` occurs more than once are told apart by their text:
    they alone are fingerprinted a second time, and combined before a shuffle.
    """
    groups = stored(near_duplicates(documents, shingle, max_bits).filter("doc_id IS NOT NULL"), "duplicate-groups")
    own = F.col("doc_id") == F.col("component_id")
    per_id = groups.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(F.when(own, F.col("fingerprint"))).alias("fp"))
    first = stored(per_id.filter("fp IS NOT NULL"), "representatives")
    # Broadcast if they measure small: texts then are not shuffled at all.
    alone, told_apart = (broadcast_if_small(first.filter(n).select("doc_id")) for n in ("n = 1", "n > 1"))
    kept = documents.join(alone, "doc_id", "left_semi")
    several = documents.join(told_apart, "doc_id", "left_semi")
    row, sign = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), fingerprint(F.col("text"), shingle)
    told = several.select(row, sign.alias("sign")).withColumn("sign", F.lower(F.lpad(F.hex("sign"), 16, "0")))
    names = first.filter("n > 1").select(F.col("doc_id").alias("id"), "fp")
    ours = told.join(names, (F.col("row.doc_id") == F.col("id")) & (F.col("sign") == F.col("fp")), "left_semi")
    one = ours.groupBy(F.col("row.doc_id").alias("id")).agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    return kept.select(*columns).unionByName(one).unionByName(documents.filter(F.col("doc_id").isNull()))
