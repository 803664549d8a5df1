"""Greedy word-piece lengths by a longest-match automaton that builds no pieces."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import bounded_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# How a text falls into words for a byte-level vocabulary; every character belongs to one. Fixed value.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
COUNTS = "struct<n_words:long,n_tokens:long,n_unknown:long>"
_MEMO = 400_000
_NONE = -1


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it can be printed, else the next unused one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b if b in shown else next(other)) for b in range(256)]


class LongestMatch:
    """A trie of the vocabulary with failure links and counts of popped tokens.

    Where a match cannot go on, the failure link leads to the node of what remains
    after the longest tokens in front are popped, and the node knows how many
    these are. So every letter is read once, and no token is cut out or looked up.
    ``continuing`` marks pieces that do not start a word, as ``##`` does; words
    that cannot be covered count as one unknown token.
    """

    def __init__(self, vocabulary: Iterable[str], continuing: str = "") -> None:
        self.next: dict[int, int] = {}
        inner = 1 if continuing else 0
        self.inner, nodes, ends = inner, 1 + inner, set()
        for piece in vocabulary:
            node, letters = 0, piece
            if continuing and piece.startswith(continuing) and len(piece) > len(continuing):
                node, letters = inner, piece[len(continuing) :]
            for letter in letters:
                key = node << 21 | ord(letter)
                found = self.next.get(key)
                if found is None:
                    found = self.next[key] = nodes
                    nodes += 1
                node = found
            if letters:
                ends.add(node)
        self.link, self.popped = [_NONE] * nodes, [0] * nodes
        children: dict[int, list[tuple[int, int]]] = {}
        for key, child in self.next.items():
            children.setdefault(key >> 21, []).append((key & 0x1FFFFF, child))
        queue = deque({0, inner})
        while queue:
            node = queue.popleft()
            for letter, child in children.get(node, ()):
                self._connect(node, letter, child, child in ends)
                queue.append(child)

    def _connect(self, node: int, letter: int, child: int, ends: bool) -> None:
        if ends:
            self.link[child], self.popped[child] = self.inner, 1
            return
        at, popped = self.link[node], self.popped[node]
        while at != _NONE and (at << 21 | letter) not in self.next:
            popped += self.popped[at]
            at = self.link[at]
        if at != _NONE:
            self.link[child], self.popped[child] = self.next[at << 21 | letter], popped

    def count(self, word: str) -> int:
        """Tokens of a word by greedy longest match, or -1 if it cannot be covered."""
        follow, link, popped = self.next, self.link, self.popped
        node = total = 0
        for letter in map(ord, word):
            found = follow.get(node << 21 | letter)
            while found is None:
                total += popped[node]
                node = link[node]
                if node == _NONE:
                    return -1
                found = follow.get(node << 21 | letter)
            node = found
        while node > self.inner:
            total += popped[node]
            node = link[node]
            if node == _NONE:
                return -1
        return total


class Counter(dict):
    """Words to token counts, -1 for unknown; forgets everything when full."""

    def __init__(self, vocabulary: Iterable[str], byte_level: bool, continuing: str = "") -> None:
        super().__init__()
        self.automaton = LongestMatch(vocabulary, continuing)
        self.letters = byte_letters() if byte_level else None

    def __missing__(self, word: str) -> int:
        spelled = "".join(self.letters[b] for b in word.encode("utf-8", "surrogatepass")) if self.letters else word
        count = self.automaton.count(spelled)
        if len(word) <= 64:
            if len(self) >= _MEMO:
                self.clear()
            self[word] = count
        return count

    def of(self, words: list[str]) -> tuple[int, int, int]:
        """Words, tokens and, among these, unknown ones."""
        counts = list(map(self.__getitem__, words))
        unknown = counts.count(-1)
        return len(words), sum(counts) + 2 * unknown, unknown


def vocabulary_of(path: str) -> list[str]:
    """The pieces of a tokenizer's JSON file by id, special ones left out."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"] for t in content.get("added_tokens", []) if t.get("special")}
    pieces = content["model"]["vocab"]
    return [piece for piece in sorted(pieces, key=pieces.get) if piece not in special]


_BUILT: dict[str, Counter] = {}


def token_counts(
    text: Column, spark, vocabulary: list[str], word: str = WORD, byte_level: bool = True, continuing: str = ""
) -> Column:
    """``n_words``, ``n_tokens``, ``n_unknown`` of whole texts, as a struct; NULL texts count as empty."""
    shared = spark.sparkContext.broadcast(vocabulary)
    key = xxhash.xxh64_hexdigest("\n".join([*vocabulary, str(byte_level), continuing]))

    @F.pandas_udf(COUNTS)
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if key not in _BUILT:  # one automaton per worker process
            _BUILT.clear()
            _BUILT[key] = Counter(shared.value, byte_level, continuing)
        counter, find = _BUILT[key], regex.compile(word).findall
        for texts in batches:
            rows = [counter.of(find(text or "")) for text in texts]
            yield pd.DataFrame(rows, columns=["n_words", "n_tokens", "n_unknown"], dtype="int64")

    return counts(text)


def with_token_counts(documents: DataFrame, path: str = VOCABULARY, name: str = "tokens") -> DataFrame:
    """``documents`` with ``name``: a struct of the words, tokens and unknown tokens of the whole ``text``.

    NULL and empty texts have none. Repeated rows get equal counts; other columns
    pass through, and ``name`` replaces one of that name.
    """
    spark = bounded_batches(documents.sparkSession)
    return documents.withColumn(name, token_counts(F.col("text"), spark, vocabulary_of(path)))
