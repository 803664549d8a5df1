from __future__ import annotations

import random
import re

import pytest

from martloom.llm import decontamination as D
from martloom.llm.decontamination import Index, clean, contaminated, shingles_of, size_class, sketch_length, words_of

SCHEMA = "doc_id long, text string, item_id long, shingles string"


def plain(text, items, size=5, share=0.8):
    words, out = re.findall(r"\w+", (text or "").lower()), []
    for item_id, item in items:
        wanted = re.findall(r"\w+", (item or "").lower())
        n = min(size, len(wanted))
        runs = {tuple(wanted[i : i + n]) for i in range(len(wanted) - n + 1)} if n else set()
        own = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        if runs and len(runs & own) >= share * len(runs) - 1e-9:
            out.append((item_id, len(runs & own), len(runs)))
    return out


@pytest.mark.parametrize("share", [0.5, 0.8, 1.0])
def test_no_item_of_a_size_class_can_be_missed(share):
    for shingles in range(1, 3000):
        partition = size_class(shingles)
        assert 2**partition >= shingles > 2**partition // 2
        may_lack = int((1 - share) * shingles + 1e-9)
        assert may_lack < sketch_length(partition, share) <= max(1, 2**partition)


def cases():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([1, 2, 3, 4, 5, 6, 7, 9, 13, 20, 40, 80, 200])]
    items += [(50, None), (51, " .,"), (52, "W1, w2! W3? w4 w5 w6"), (None, text(12))]
    docs = [None, "", ".", "w1"]
    for _, item in items:
        own = (item or "").split()
        docs.append(f"{text(3000)} {' '.join(own)} {text(500)}")
        changed = [w if rng.random() > 0.03 else "other" for w in own]
        docs.append(f"{text(50)}. {', '.join(changed).upper()}; {text(50)}")
        docs.append(f"{text(30)} {' '.join(own[: len(own) // 2])} {text(90)} {' '.join(own[len(own) // 2:])}")
    return docs, items


def test_matches_against_brute_force(spark, monkeypatch):
    docs, items = cases()
    index = Index(items, 5, 0.8)
    for text in docs:
        assert sorted((m["item_id"], m["matched"], m["shingles"]) for m in index.matches(text) if m["item_id"] is not None) == sorted(
            x for x in plain(text, items) if x[0] is not None
        )
    expected = sorted(((i, *m) for i, t in enumerate(docs) for m in plain(t, items)), key=repr)
    documents = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(docs)], SCHEMA)
    benchmark = spark.createDataFrame([*items, *items[:3]], "item_id long, text string")
    for limit in (1 << 20, 300):
        monkeypatch.setattr(D, "BLOCK_BYTES", limit)
        got = contaminated(documents, benchmark)
        assert sorted(((r.doc_id, r.item_id, r.matched, r.shingles) for r in got.collect()), key=repr) == expected
    kept = clean(documents, benchmark)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(docs))) - {e[0] for e in expected}


def test_empty_tables_and_repeats(spark):
    none, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert contaminated(none, items).collect() == []
    docs = spark.createDataFrame([(None, "x A b\nc d, e f", 3, "z")] * 2, SCHEMA)
    assert [tuple(r) for r in contaminated(docs, items).collect()] == [(None, 1, 2, 2, 1.0)] * 2
    assert clean(docs, items.limit(0)).count() == 2 and contaminated(docs, items.limit(0)).count() == 0
    assert shingles_of(words_of("a b"), 5) == {("a", "b")}
