from __future__ import annotations

import random

import pytest
import xxhash

from martloom.llm.components import components
from martloom.llm.simhash import covering_masks, fingerprint_of, links, near_duplicates, representatives

SCHEMA = "doc_id long, text string, component_id string, fp string"


def plain_fingerprint(text, size=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for white in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(white, " ")
    words = [w for w in lowered.split(" ") if w]
    runs = [words[i : i + size] for i in range(len(words) - size + 1)] if len(words) >= size else [words] * bool(words)
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize(
    "text", [None, "", " \n\t", "One", "one TWO", "Größe ÄB c\x0bD e f", "a b c", "x " * 9000 + "y z"]
)
def test_fingerprint_equals_the_definition(text):
    assert fingerprint_of(text) % (1 << 64) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_some_mask_covers_every_change_within_the_radius(radius):
    masks, rng = covering_masks(radius), random.Random(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        change = sum(1 << i for i in rng.sample(range(64), radius))
        assert any(not mask & change for mask in masks)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_join_what_all_pairs_join(spark, radius):
    rng = random.Random(radius)
    words = set()
    for _ in range(12):
        word = rng.getrandbits(64)
        for _ in range(10):
            words.add(word - (1 << 64) if word >> 63 else word)
            for _ in range(rng.randint(1, 4)):
                word ^= 1 << rng.randrange(64)
    expected = plain_components(words, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= radius)
    edges = links(spark.createDataFrame([(w,) for w in words], "fp long"), radius)
    found = {r.node: r.root for r in components(edges).collect()}
    assert {w: found.get(w, w) for w in words} == expected


def test_components_of_a_path_a_star_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    edges = spark.createDataFrame([*path, *star, (5, 5), (None, 3), (160, 159)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**dict.fromkeys(range(100, 161), 100), 7: 7, **dict.fromkeys(range(200, 260), 7)}
    assert components(edges.limit(0)).count() == 0


def test_near_duplicates_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    prints = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    expected = plain_components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = near_duplicates(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        d: (f"{prints[d]:016x}", expected[d]) for d in prints
    }
    assert len(got) == len(docs)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(3, None, "x", "y"), (2, "", "x", "y"), (2, "", "x", "y"), (None, "a b c d", None, None), (9, "A b\nc d", "", "")]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    found = sorted(((r.doc_id, r.component_id) for r in got.collect()), key=repr)
    assert found == [(2, 2), (2, 2), (3, 2), (9, 9), (None, 9)]
    alone = near_duplicates(spark.createDataFrame([(None, "a b c d", "", "")], SCHEMA)).collect()
    assert [(r.doc_id, r.component_id) for r in alone] == [(None, None)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("turn", [0, 1, 2])
def test_the_representative_is_the_groups_own_row(spark, turn):
    a, b = "one two three four five", "quite another text of its own"
    rows = [(1, a, "x", "f"), (5, a, "x", "f"), (5, b, "x", "f"), (7, b, None, None), (5, b, "x", "f"), (9, "", "", ""), (9, None, "", ""), (None, a, "", "")]
    rows = rows[turn:] + rows[:turn]
    got = representatives(spark.createDataFrame(rows if turn < 2 else rows[::-1], SCHEMA))
    assert got.columns == ["doc_id", "text", "component_id", "fp"]
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    assert [k for k in kept if k[0] != 9] == [(1, a), (5, b), (None, a)] and len(kept) == 4
    assert representatives(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_group_of_copies_of_one_number_keeps_one_row(spark):
    rows = [(4, "a b c d e", "", "")] * 500 + [(4, "a b c d e", "other", "")] + [(i, f"word{i} and more{i} so{i}", "", "") for i in range(5, 50)]
    got = representatives(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(got) == 46 and len({r.doc_id for r in got}) == 46
