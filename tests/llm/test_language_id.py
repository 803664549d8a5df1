from __future__ import annotations

from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import language_id as L
from martloom.llm.catalogue import op3_language_id

SCHEMA = "doc_id long, text string, lang string, score string"


def segmentations(word, pieces):
    if not word:
        yield []
    for b in range(1, len(word) + 1):
        at = pieces.number.get(word[:b], pieces.unknown if b == 1 else None)
        if at is not None:
            yield from ([at, *rest] for rest in segmentations(word[b:], pieces))


def test_forward_sums_all_segmentations():
    pieces = L.Pieces(["▁", "a", "b", "ab", "ba", "▁a", "aba", "▁AB"])
    rng = np.random.default_rng(1)
    p = rng.random((pieces.size, 3))
    words = ["▁ab", "▁abab", "▁ç", "▁aça", "b", "▁" + "ab" * 5]
    got = L.log_likelihoods(pieces, words, L.lifted(pieces, p))
    for word, row in zip(words, got):
        expected = sum(np.prod(p[s], axis=0) for s in segmentations(word, pieces))
        assert row == pytest.approx(np.log(expected))


def test_expected_counts_and_learning_by_enumeration():
    pieces = L.Pieces(["▁", "a", "b", "ab", "▁a", "bab"])
    words, times = ["▁ab", "▁bab", "▁aab"], np.array([3.0, 1.0, 2.0])
    p = np.random.default_rng(2).random((pieces.size, 1))
    expected = np.zeros(pieces.size)
    for word, n in zip(words, times):
        ways = list(segmentations(word, pieces))
        chances = np.array([np.prod(p[w, 0]) for w in ways])
        for way, chance in zip(ways, chances / chances.sum()):
            np.add.at(expected, way, n * chance)
    sizes = np.array([len(w) for w in words])
    got = L.expected_counts(pieces, pieces.edges(words), sizes, times, L.lifted(pieces, p))
    assert got == pytest.approx(expected)
    value = lambda q: (L.log_likelihoods(pieces, words, L.lifted(pieces, q[:, None]))[:, 0] * times).sum()
    rounds = [value(L.fit(pieces, words, times, r)) for r in range(6)]
    assert all(b >= a - 0.2 for a, b in zip(rounds, rounds[1:])) and rounds[5] > rounds[0]


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op3_language_id(spark, sf).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    right = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert len(right) > 100 and np.mean(right) > 0.97


def test_edges(spark):
    rows = [(i, f"{'der die das und nicht' if i % 2 else 'the and of with that'} x{i}", "de" if i % 2 else "en", "") for i in range(40)]
    odd = [(100, None, "en", ""), (101, "12 ½ !?", "de", ""), (102, "", None, ""), (None, "the THE", None, ""), (104, "der" * 9000 + " die", None, "")]
    docs = spark.createDataFrame([*rows, *odd, *odd], SCHEMA)
    got = L.identified(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == 50
    found = {r.doc_id: (r.lang_pred, r.held_out) for r in got.collect()}
    assert [found[d][0] for d in (100, 101, 102, None, 104)] == ["und", "und", "und", "en", "de"]
    assert found[None][1] is False
    turned = docs.replace({"de": "xx"}, subset=["lang"]).where("crc32(cast(doc_id as string)) % 4 = 2").unionByName(
        docs.where("crc32(cast(doc_id as string)) % 4 != 2"))
    assert "xx" not in {r.lang_pred for r in L.identified(turned).collect()}
    assert {(r.lang_pred, r.score) for r in L.identified(docs.withColumn("lang", docs.score.cast("string")).replace({"": None}, subset=["lang"])).collect()} == {("und", 0.0)}
    assert L.identified(docs.limit(0)).collect() == []


def test_a_hot_language_is_cut_down_before_it_is_ranked(spark):
    rows = [(i, "", "hot" if i % 9 else "rare", "") for i in range(20000)] + [(7, "", "hot", ""), (None, "", "hot", ""), (5, "", None, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = {r.doc_id: r.m for r in docs.select("doc_id", F.xxhash64("doc_id").alias("m")).collect()}
    ranked = []
    for lang in ("hot", "rare"):
        own = sorted((marks[i], i) for i in {i for i, _, x, _ in rows if x == lang and i is not None and crc32(str(i).encode()) % 4 != 2})
        ranked += [(k, lang, i) for k, (_, i) in enumerate(own)]
    assert {(r.doc_id, r.lang) for r in L.sampled(docs, 300).collect()} == {(i, lang) for _, lang, i in sorted(ranked)[:300]}
    left = L.foremost(docs.select("doc_id", "lang"), 300).groupBy("lang").count().collect()
    assert all(300 <= r["count"] <= 320 for r in left if r.lang)


def test_pieces_of_words_equal_a_plain_search():
    pieces = L.Pieces(["▁", "a", "b", "ab", "▁ab", "abba", "ß", "é", "日本", "𝒳a", "A", "zz"])
    rng = np.random.default_rng(3)
    letters = list("▁ab" * 3 + "ßé日本𝒳zq\U0010ffff")
    words = ["".join(rng.choice(letters, rng.integers(1, L.LONGEST + 1))) for _ in range(500)] + ["z", "zz", "日", "▁" + "ab" * 20]
    expected = set()
    for w, word in enumerate(words):
        for a in range(len(word)):
            for b in range(a + 1, len(word) + 1):
                at = pieces.number.get(word[a:b], pieces.unknown if b == a + 1 else None)
                if at is not None:
                    expected.add((w, a, b, at))
    got = [tuple(map(int, edge)) for edge in pieces.edges(words)]
    assert len(got) == len(expected) and set(got) == expected


def test_words_of_texts_of_ascii_and_others():
    for text in ("The CAT's 2nd x_y\nend", "a" * 47, "b" * 48 + " c " + "d" * 200, "", None, "12 !"):
        mixed = f"é1{text or ''}"
        assert L.words_of(mixed)[0] == "▁é" and L.words_of(mixed)[1:] == L.words_of(text)
    assert L.words_of("b" * 48) == ["▁" + "b" * 47, "b"]
    assert L.words_of("İx é") == ["▁i̇x", "▁é"]


def test_a_prediction_does_not_depend_on_what_was_forgotten():
    pieces = ["▁", *"abcdefgh", "ab", "cd"]
    model = L.Model(["x", "y"], pieces, np.random.default_rng(4).random((L.Pieces(pieces).size, 2)))
    rng = np.random.default_rng(5)
    texts = [" ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(40)) for _ in range(30)] + ["", None]
    whole, small = L.Identifier(model), L.Identifier(model)
    small.room = 50
    assert [r for i in range(0, 32, 4) for r in small.predict(texts[i : i + 4])] == whole.predict(texts)
    assert len(small.known) < len(whole.known)
