from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from martloom.llm import mixing
from martloom.llm.mixing import mixed, mixture, running_total, schedule, targets

SCHEMA = "doc_id long, text string, source string, size string, key string, number string"


def plain_targets(sizes, weights=(5, 2, 1), share=Fraction(3, 2), most=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not above:
            out |= {s: left * weight[s] / total for s in open_}
            break
        out |= {s: Fraction(most * sizes[s]) for s in above}
        left -= sum(most * sizes[s] for s in above)
        open_ -= above
    return order, out


def plain(rows, block=1000, seed=13):
    """Every word of the shuffled sources, every slot in turn."""
    sized = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, s in rows]
    sizes = defaultdict(int)
    for _, n, s in sized:
        sizes[s] += n
    order, target = plain_targets(sizes)

    def key(row):
        text = f"{seed}:{row[0]}" if row[0] is not None else str(seed)
        return int(hashlib.sha256(text.encode()).hexdigest()[:15], 16), row[0] is not None, row[0] or 0, row[1]

    stream = {s: [k for k in sorted((k for k in range(len(sized)) if sized[k][2] == s), key=lambda k: key(sized[k])) for _ in range(sized[k][1])] for s in order}
    quota = {s: int(target[s]) for s in order}
    blocks = {s: -(-quota[s] // block) for s in order}
    n = sum(blocks.values())
    bits = max(1, (max(n, 2) - 1).bit_length())
    taken, slot_of, used = [0] * len(sized), [None] * len(sized), dict.fromkeys(order, 0)
    for i in range(1 << bits):
        point, at = Fraction(int(f"{i:0{bits}b}"[::-1], 2), 1 << bits) * n, 0
        for s in order:
            if at <= point < at + blocks[s]:
                break
            at += blocks[s]
        else:
            continue
        r = used[s]
        if r == blocks[s]:
            continue
        used[s] += 1
        for w in range(r * block, min((r + 1) * block, quota[s])):
            k = stream[s][w % len(stream[s])]
            taken[k] += 1
            slot_of[k] = i if slot_of[k] is None else slot_of[k]
    assert used == blocks
    return sorted(
        ((i, n, sizes[s], float(target[s]), taken[k], slot_of[k]) for k, (i, n, s) in enumerate(sized)), key=repr
    )


def close(got, expected):
    got, expected = sorted((tuple(r) for r in got), key=repr), expected
    assert len(got) == len(expected)
    for a, b in zip(sorted(got, key=lambda r: repr(r[:3] + r[4:])), sorted(expected, key=lambda r: repr(r[:3] + r[4:]))):
        assert a[:3] + a[4:] == b[:3] + b[4:]
        assert a[3] == pytest.approx(b[3], rel=1e-12)


def test_whole_table_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in table.collect()]
    got = mixed(table)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken", "first_slot"]
    close(got.collect(), plain(rows))
    assert sorted(map(tuple, mixed(table.repartition(7)).collect())) == sorted(map(tuple, got.collect()))


def test_nulls_empties_ties_repeats_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 2)
    rng = random.Random(2)
    rows = [(rng.randrange(40), "w " * rng.randrange(30), rng.choice(["b", "a", "hot", "hot", "hot", "é", "", None])) for _ in range(150)]
    rows += [(None, "x y z", "a"), (None, None, "a"), (7, None, "only null"), (8, " \n", "none"), (9, "one", "tiny")] + rows[:9]
    table = spark.createDataFrame([(*r, "s", "k", "n") for r in rows], SCHEMA)
    close(mixed(table, block_words=7).collect(), plain(rows, 7))
    assert mixed(table.limit(0)).collect() == []
    wordless = table.filter("text is null or source = 'none'")
    assert all(r.taken == 0 and r.target == 0 and r.first_slot is None for r in mixed(wordless).collect())


def test_parts_fill_the_slots(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(60), f"s{i % 5 if i % 3 else 0}") for i in range(200)]
    laid, parts = mixture(spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA), block_words=10)
    per_slot = {r.slot: (r.n, r.sources) for r in parts.groupBy("slot").agg(F.sum("words").alias("n"), F.countDistinct("number").alias("sources")).collect()}
    assert all(n <= 10 and sources == 1 for n, sources in per_slot.values())
    # Each source may have one block that is not full.
    assert sum(n < 10 for n, _ in per_slot.values()) <= 5
    whole = {r.number: (r.quota, r.n) for r in parts.groupBy("number").agg(F.sum("words").alias("n")).join(
        laid.groupBy("number").agg(F.floor(F.max("target")).alias("quota")), "number").collect()}
    assert all(quota == n for quota, n in whole.values())


def test_every_stretch_of_the_schedule_is_near_the_weights(spark):
    sources = spark.createDataFrame([(chr(97 + i), 1000 * w) for i, w in enumerate([40, 900, 300, 5, 77, 1])], "source string, source_size long")
    told = targets(sources)
    quota = {r.number: r.quota for r in told.collect()}
    slots = sorted((r.slot, r.number, r["rank"]) for r in schedule(told, 100).collect())
    n = len(slots)
    assert n == sum(-(-q // 100) for q in quota.values())
    for number, q in quota.items():
        own = [k for k, (_, s, _) in enumerate(slots) if s == number]
        assert [slots[k][2] for k in own] == list(range(len(own)))
        # Before any source has run out, each is within a few blocks of its share.
        for seen, k in enumerate(own):
            if slots[k][0] < n // 2:
                assert abs(seen - slots[k][0] * len(own) / n) < 8


@pytest.mark.parametrize("sizes", [{}, {"a": 0}, {"a": 10}, {"a": 10, None: 3}, {"z": 1, "b": 1000, "Z": 5, "ä": 80}])
def test_targets_stop_at_twice_the_source(spark, sizes):
    _, expected = plain_targets(sizes)
    got = {r.source: (r.target, r.quota) for r in targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == {s: (pytest.approx(float(t), rel=1e-12), int(t)) for s, t in expected.items()}


def test_running_total_of_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    rng = random.Random(4)
    rows = [(rng.choice([0, 0, 0, 1, 2]), rng.getrandbits(20), rng.randrange(9)) for _ in range(500)]
    table = spark.createDataFrame(rows, "g long, k long, v long")
    got = sorted(map(tuple, running_total(table, "g", "k", 20, "v", "before", ["v"]).collect()))
    seen, expected = defaultdict(int), []
    for g, k, v in sorted(rows):
        expected.append((g, k, v, seen[g]))
        seen[g] += v
    assert got == sorted(expected)
