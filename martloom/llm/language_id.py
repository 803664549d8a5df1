"""Language identification by unigrams of pieces, summed over all segmentations."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.quality import remainder
from martloom.llm.sentencepiece_codec import MODEL, NORMAL, SPACE, parse
from martloom.llm.shared import bounded_batches, stored

UNDETERMINED = "und"
# At most so many documents are learned from, dealt to the languages in turn.
SAMPLE_ROWS = 2_400
# Leading bits of the hash by which the documents of a language are counted, first coarsely.
RANGES = (9, 18)
ROUNDS = 5
SMOOTH = 0.05
# Longer runs of letters are taken in pieces of this length.
LONGEST = 48
# A factor per letter that keeps products of probabilities within a double.
LIFT = 16.0
RESULT = "struct<lang_pred:string,score:double>"
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
# The same in a text of ASCII alone, in lower case.
_ASCII_WORD = re.compile("[a-z]+")
_MEMO_BYTES = 48 << 20
# Words handled in one array, for one language.
_TOGETHER = 1 << 14


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case, each behind a mark; a very long run is cut, the rest without a mark."""
    text = (text or "").lower()
    found = (_ASCII_WORD if text.isascii() else _WORD).findall(text)
    if max(map(len, found), default=0) < LONGEST:
        return [SPACE + word for word in found]
    marked = [SPACE + word for word in found]
    return [word[i : i + LONGEST] for word in marked for i in range(0, len(word), LONGEST)]


class Pieces:
    """The fixed vocabulary: piece numbers, and the tree of all starts of pieces.

    A start of a piece is a node, 0 the empty one. The branches lie in a sorted
    array of node times alphabet plus letter, so that all places of many words
    go a letter further at once.
    """

    def __init__(self, pieces: list[str]) -> None:
        self.number = {piece: i for i, piece in enumerate(dict.fromkeys(p.lower() for p in pieces))}
        self.unknown = len(self.number)
        self.size = self.unknown + 1
        nodes = {"": 0}
        for piece in self.number:
            for i in range(1, len(piece) + 1):
                nodes.setdefault(piece[:i], len(nodes))
        letters = {letter: i for i, letter in enumerate(sorted({start[-1] for start in nodes if start}), 1)}
        self.alphabet = len(letters) + 1
        self.letter = np.zeros(sys.maxunicode + 1, np.int32)
        self.letter[[ord(letter) for letter in letters]] = list(letters.values())
        branches = sorted((nodes[start[:-1]] * self.alphabet + letters[start[-1]], node) for start, node in nodes.items() if start)
        # The last branch is one that no place asks for: a search ends there at the latest.
        self.branches, self.reached = np.array([*branches, (np.iinfo(np.int64).max, 0)], np.int64).T.copy()
        self.piece = np.array([self.number.get(start, -1) for start in nodes], np.int64)

    def edges(self, words: list[str]) -> np.ndarray:
        """``word, start, end, piece`` of every piece in every word; letters without a piece are unknown ones."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = self.letter[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        begins = np.cumsum(sizes) - sizes
        word = np.repeat(np.arange(len(words)), sizes)
        place, stop = np.arange(len(letters)), (begins + sizes)[word]
        node, length, out = np.zeros(len(letters), np.int64), 0, []
        while len(place):
            wanted = node * self.alphabet + letters[place + length]
            at = np.searchsorted(self.branches, wanted)
            known = self.branches[at] == wanted
            node, length = self.reached[at], length + 1
            piece = np.where(known, self.piece[node], -1)
            if length == 1:
                piece = np.where(piece < 0, self.unknown, piece)
            ended = np.flatnonzero(piece >= 0)
            start = (place - begins[word])[ended]
            out.append(np.stack([word[ended], start, start + length, piece[ended]], axis=1))
            further = np.flatnonzero(known & (place + length < stop))
            word, place, stop, node = word[further], place[further], stop[further], node[further]
        return np.concatenate(out) if out else np.zeros((0, 4), np.int64)


def forward(edges: np.ndarray, count: int, weights: np.ndarray) -> np.ndarray:
    """Per word, place and column of ``weights``, the sum over all segmentations up to the place.

    ``weights`` holds lifted probabilities, a row per piece and a column per language.
    """
    alpha = np.zeros((LONGEST + 2, count, weights.shape[1]))
    alpha[0] = 1.0
    edges = edges[np.argsort(edges[:, 2] * count + edges[:, 0], kind="stable")]
    for step in np.split(edges, np.flatnonzero(np.diff(edges[:, 2])) + 1) if len(edges) else []:
        word, start, end, piece = step.T
        firsts = np.flatnonzero(np.concatenate([[True], np.diff(word) > 0]))
        alpha[end[0], word[firsts]] = np.add.reduceat(alpha[start, word] * weights[piece], firsts, axis=0)
    return alpha


def log_likelihoods(pieces: Pieces, words: list[str], weights: np.ndarray) -> np.ndarray:
    """Log-probability of each word in each language, all segmentations together."""
    if not words:
        return np.zeros((0, weights.shape[1]))
    alpha = forward(pieces.edges(words), len(words), weights)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    last = alpha[sizes, np.arange(len(words))]
    return np.log(np.maximum(last, 1e-300)) - sizes[:, None] * np.log(LIFT)


def lifted(pieces: Pieces, probabilities: np.ndarray) -> np.ndarray:
    """Probabilities times ``LIFT`` to the length of the piece."""
    sizes = np.array([*map(len, pieces.number), 1], np.float64)
    return probabilities * (LIFT**sizes)[:, None]


def expected_counts(pieces: Pieces, edges: np.ndarray, sizes: np.ndarray, times: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How often each piece is expected in words that occur ``times``, over all their segmentations."""
    n = len(sizes)
    alpha = forward(edges, n, weights)[:, :, 0]
    turned = edges.copy()
    turned[:, 1], turned[:, 2] = sizes[edges[:, 0]] - edges[:, 2], sizes[edges[:, 0]] - edges[:, 1]
    beta = forward(turned, n, weights)[:, :, 0]
    word, start, end, piece = edges.T
    total = np.maximum(alpha[sizes, np.arange(n)], 1e-300)
    share = alpha[start, word] * weights[piece, 0] * beta[sizes[word] - end, word] / total[word]
    return np.bincount(piece, share * times[word], minlength=pieces.size)


def fit(pieces: Pieces, words: list[str], times: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language by expectation-maximisation over its word counts."""
    parts = []
    for i in range(0, len(words), _TOGETHER):
        some = words[i : i + _TOGETHER]
        parts.append((pieces.edges(some), np.fromiter(map(len, some), np.int64, len(some)), times[i : i + _TOGETHER]))
    counts = sum(np.bincount(e[:, 3], t[e[:, 0]], minlength=pieces.size) for e, _, t in parts)
    share = lambda counts: (counts + SMOOTH) / (counts.sum() + SMOOTH * pieces.size)
    for _ in range(rounds):
        weights = lifted(pieces, share(counts)[:, None])
        counts = sum(expected_counts(pieces, *part, weights) for part in parts)
    return share(counts)


@dataclass(frozen=True)
class Model:
    """Languages in order of name, the vocabulary, and a column of piece probabilities per language."""

    languages: list[str]
    pieces: list[str]
    probabilities: np.ndarray


class _Numbers(dict):
    """Words and their numbers; a new word gets the next one."""

    def __missing__(self, word: str) -> int:
        self[word] = len(self)
        return len(self) - 1


class Identifier:
    """Predicts texts; keeps the likelihoods of the words met so far, within a bound."""

    def __init__(self, model: Model) -> None:
        self.languages = model.languages
        self.pieces = Pieces(model.pieces)
        self.weights = lifted(self.pieces, model.probabilities)
        self.room = max(1000, _MEMO_BYTES // (8 * max(1, len(model.languages)) + 200))
        self.rows, self.known = np.zeros((0, len(model.languages))), _Numbers()

    def _numbered(self, lists: list[list[str]]) -> list[np.ndarray]:
        """The rows of the words of each list, new words learned; beyond the bound, all words are forgotten first."""
        if len(self.known) > self.room:
            self.rows, self.known = self.rows[:0], _Numbers()
        at = [np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)) for words in lists]
        fresh = list(islice(self.known, len(self.rows), None))
        block = max(64, _TOGETHER // len(self.languages))
        parts = [log_likelihoods(self.pieces, fresh[i : i + block], self.weights) for i in range(0, len(fresh), block)]
        self.rows = np.concatenate([self.rows, *parts])
        return at

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The most likely language of each text and its probability, all languages being as likely beforehand."""
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        out = []
        for at in self._numbered([words_of(text) for text in texts]):
            if not len(at):
                out.append((UNDETERMINED, 0.0))
                continue
            log = self.rows[at].sum(axis=0)
            shares = np.exp(log - log.max())
            out.append((self.languages[int(log.argmax())], float(1 / shares.sum())))
        return out


def foremost(known: DataFrame, rows: int) -> DataFrame:
    """Of ``doc_id``, ``lang`` a few more than the first ``rows`` of every language, by a hash of ``doc_id``.

    Counted by ranges of the hash, a language is cut down to the ranges that its
    first rows are in, and those once more by finer ranges, so that however
    frequent it is, about as many rows are left to be ranked as there are to be.
    """
    for bits in RANGES:
        ranged = known.withColumn("range", F.shiftright(F.xxhash64("doc_id"), 64 - bits))
        earlier = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        counts = ranged.groupBy("lang", "range").agg(F.count("*").alias("n"))
        before = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        needed = before.filter(F.col("before") < rows).select("lang", "range")
        known = ranged.join(needed, ["lang", "range"], "left_semi").drop("range")
    return known


def sampled(documents: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``lang`` of at most ``rows`` documents with a language outside the held-out fold.

    Documents are ranked in each language by a hash of their number, and taken by
    rank, so that no language crowds out another.
    """
    learnt = documents.filter(F.col("lang").isNotNull() & (remainder() != 2)).select("doc_id", "lang").distinct()
    whole = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = foremost(stored(learnt, "labelled"), rows).withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= rows)
    return ranked.orderBy("rank", "lang").limit(rows).select("doc_id", "lang")


def word_counts(documents: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``lang``, ``word``, ``times`` of the sampled documents."""
    chosen = sampled(documents, rows)

    @F.pandas_udf("array<string>")
    def words(texts: pd.Series) -> pd.Series:
        return pd.Series([words_of(text) for text in texts])

    # The chosen numbers are at most ``rows``; of rows that repeat one, a single text counts.
    found = documents.select("doc_id", "text", "lang").join(F.broadcast(chosen), ["doc_id", "lang"])
    taken = found.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    return taken.select("lang", F.explode(words("text")).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("times"))


def learn(documents: DataFrame, path: str = MODEL, rows: int = SAMPLE_ROWS) -> Model:
    """A model of every language in the bounded sample, over the pieces of a public vocabulary."""
    with open(path, "rb") as file:
        names = [piece for piece, _, kind in parse(file.read()).pieces if kind == NORMAL]
    pieces = Pieces(names)
    counts = stored(word_counts(documents, rows), "language-words").orderBy("lang", "word").toPandas()
    columns, languages = [], []
    for language, own in counts.groupby("lang", sort=True):
        languages.append(language)
        columns.append(fit(pieces, own["word"].tolist(), own["times"].to_numpy(np.float64)))
    probabilities = np.stack(columns, axis=1) if columns else np.zeros((pieces.size, 0))
    return Model(languages, names, probabilities)


def predict(text: Column, spark, model: Model) -> Column:
    """``lang_pred`` and ``score`` of whole texts, as a struct."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predictions(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Identifier(shared.value)
        for texts in batches:
            rows: list[tuple] = []
            texts = texts.tolist()
            for i in range(0, len(texts), 64):
                rows += own.predict(texts[i : i + 64])
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return predictions(text)


def identified(documents: DataFrame, path: str = MODEL, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, one row per document.

    The model is learned from ``text`` and ``lang`` of documents outside the
    held-out fold, at most ``rows`` of them; a prediction looks at the whole text
    alone. NULL texts and texts without a letter are ``und`` with score 0, and so
    is every text if there is nothing to learn from. Equal likelihoods go to the
    first name. A NULL ``doc_id`` is neither learned from nor held out. Other
    columns are not read.
    """
    spark = bounded_batches(documents.sparkSession)
    found = predict(F.col("text"), spark, learn(documents, path, rows))
    held_out = F.coalesce(remainder() == 2, F.lit(False)).alias("held_out")
    return documents.select("doc_id", held_out, found.alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")
