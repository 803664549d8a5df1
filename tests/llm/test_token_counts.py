from __future__ import annotations

import random

import regex

from martloom.llm.catalogue import op8_token_counts
from martloom.llm.token_counts import VOCABULARY, WORD, LongestMatch, byte_letters, vocabulary_of, with_token_counts


def greedy(word, vocabulary, continuing=""):
    at = count = 0
    longest = max(map(len, vocabulary)) if len(vocabulary) < 99 else 128
    while at < len(word):
        mark = continuing if at else ""
        ends = [b for b in range(min(len(word), at + longest), at, -1) if mark + word[at:b] in vocabulary and (at or not continuing or not word.startswith(continuing))]
        if not ends:
            return -1
        at, count = ends[0], count + 1
    return count


def test_automaton_equals_greedy_search():
    rng = random.Random(4)
    for trial in range(300):
        mark = "##" if trial % 2 else ""
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 25))}
        vocabulary = {(mark if rng.random() < 0.6 else "") + p for p in pieces}
        automaton = LongestMatch(vocabulary, mark)
        for _ in range(60):
            word = "".join(rng.choice("abcd#"[: rng.choice([3, 3, 3, 5])]) for _ in range(rng.randint(0, 14)))
            assert automaton.count(word) == greedy(word, vocabulary, mark), (vocabulary, word)


def plain_counts(text, vocabulary):
    letters, words = byte_letters(), regex.findall(WORD, text or "")
    assert "".join(words) == (text or "")
    counts = [greedy("".join(letters[b] for b in w.encode()), vocabulary) for w in words]
    assert -1 not in counts
    return len(words), sum(counts), 0


def test_query_against_brute_force(spark):
    sf, vocabulary = "/root/testdata/sf0.001", set(vocabulary_of(VOCABULARY))
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op8_token_counts(spark, sf).collect()
    assert len(rows) == len(docs)
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {d: plain_counts(t, vocabulary) for d, t in docs.items()}


def test_nulls_long_words_and_clashing_names(spark):
    texts = [None, "", "  \n\t ", "Größe 😀", "x" * 9000, "it's 1234 !!", "it's 1234 !!"]
    docs = spark.createDataFrame([(i, t, "a", None) for i, t in enumerate(texts)], "doc_id long, text string, tokens string, n_words long")
    got = with_token_counts(docs)
    assert got.columns == docs.columns
    vocabulary = set(vocabulary_of(VOCABULARY))
    assert {r.doc_id: tuple(r.tokens) for r in got.collect()} == {i: plain_counts(t, vocabulary) for i, t in enumerate(texts)}
    assert with_token_counts(docs.limit(0)).collect() == []
