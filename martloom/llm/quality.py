"""Quality classifier: naive Bayes support vectors over n-gram indicators."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.shared import bounded_batches, stored

# Features are hashed into this many places.
PLACES = 1 << 20
# Bounds of the sample the model is fitted on: labelled rows, and the features
# of all their texts together (4 bytes each on the driver). A text of more than
# LONG_TEXT features is taken only after all shorter ones.
SAMPLE_ROWS = 9_000
SAMPLE_FEATURES = 20_000_000
LONG_TEXT = 200_000
THRESHOLD = 0.7
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_MEMO = 300_000


class _Codes(dict):
    """Token to a 32-bit code; forgets everything when full."""

    def __missing__(self, token: str) -> int:
        if len(self) >= _MEMO:
            self.clear()
        code = crc32(token.encode("utf-8", "surrogatepass"))
        if len(token) <= 64:
            self[token] = code
        return code


def _mixed(codes: np.ndarray) -> np.ndarray:
    codes = (codes ^ (codes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((codes >> np.uint64(40)) % np.uint64(PLACES)).astype(np.int32)


def _repeats(codes: np.ndarray) -> list[int]:
    """One number for each n up to 4 and power of two that the longest run of one repeated n-gram reaches."""
    found = []
    for n in range(1, 5):
        differs = np.flatnonzero(codes[n:] != codes[:-n])
        longest = int(np.diff(np.concatenate([[-1], differs, [max(0, len(codes) - n)]])).max()) - 1
        found += [(1 << 34) + 64 * n + power for power in range(max(longest, 0).bit_length())]
    return found


def features_of(text: str | None, codes: dict[str, int]) -> np.ndarray:
    """Hashed places of the n-grams that occur in a whole text, in lower case.

    These are its distinct words, signs and pairs of neighbours, and n-grams of
    any words that follow themselves, by how often.
    """
    tokens = _TOKEN.findall((text or "").lower())
    one = np.fromiter(map(codes.__getitem__, tokens), np.uint64, len(tokens))
    two = one[:-1] * np.uint64(0x100000001B3) + one[1:] + np.uint64(1 << 33)
    return np.unique(_mixed(np.concatenate([one, two, np.array(_repeats(one), np.uint64)])))


@dataclass(frozen=True)
class Model:
    """Weights per place, already scaled by the log-count ratios, and the sigmoid of the margins."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, places: np.ndarray) -> float:
        return float(self.weights[places].sum(dtype=np.float64)) / max(1.0, len(places)) ** 0.5 + self.bias

    def score(self, places: np.ndarray) -> float:
        z = self.slope * self.margin(places) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Per place, the log of its share among good rows over its share among bad ones."""
    counts = [np.full(PLACES, smooth) for _ in range(2)]
    for places, label in zip(rows, good):
        counts[int(label)][places] += 1
    bad, fine = (c / c.sum() for c in counts)
    return np.log(fine / bad)


def dual_coordinate_descent(
    rows: list[np.ndarray], good: np.ndarray, ratios: np.ndarray, c: float = 1.0, rounds: int = 12, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Linear hinge-loss model over ratio-scaled indicators of unit-scaled rows.

    Solves the dual one variable at a time, each clipped to ``[0, c]``; the rarer
    class gets the larger ``c``. Returns weights per place, and the bias as the
    weight of a constant feature.
    """
    values = [ratios[p] / max(1.0, len(p)) ** 0.5 for p in rows]
    squares = np.array([float(v @ v) + 1.0 for v in values])
    signs = np.where(good, 1.0, -1.0)
    share = max(good.mean(), 1e-9), max(1 - good.mean(), 1e-9)
    most = np.where(good, c * 0.5 / share[0], c * 0.5 / share[1])
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(PLACES), 0.0
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            places, value = rows[i], values[i]
            gradient = signs[i] * (float(weights[places] @ value) + bias) - 1.0
            step = min(max(alpha[i] - gradient / squares[i], 0.0), most[i]) - alpha[i]
            if step:
                alpha[i] += step
                weights[places] += step * signs[i] * value
                bias += step * signs[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def sigmoid_of(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make margins probabilities, by Newton steps with smoothed targets."""
    n = good.sum(), (~good).sum()
    target = np.where(good, (n[0] + 1) / (n[0] + 2), 1 / (n[1] + 2))
    slope, offset = 1.0, float(np.log((n[0] + 1) / (n[1] + 1)))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        d, h = p - target, p * (1 - p) + 1e-9
        g = np.array([(d * margins).sum() + 1e-3 * (slope - 1), d.sum()])
        m = np.array([[(h * margins**2).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum()]])
        step = np.linalg.solve(m + 1e-9 * np.eye(2), g)
        slope, offset = slope - step[0], offset - step[1]
        if abs(step).max() < 1e-6:
            break
    return float(slope), float(offset)


def fit(rows: list[np.ndarray], good: np.ndarray, aside: np.ndarray) -> Model:
    """Fit on the rows not set ``aside`` and turn margins into probabilities on those that are.

    Where a class is missing in either part, the model is the smoothed share of good rows.
    """
    parts = [(~aside, good[~aside]), (aside, good[aside])]
    if any(labels.all() or not labels.any() for _, labels in parts):
        share = (good.sum() + 1) / (len(good) + 2)
        return Model(np.zeros(PLACES, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    train = [rows[i] for i in np.flatnonzero(~aside)]
    ratios = log_count_ratios(train, good[~aside])
    weights, bias = dual_coordinate_descent(train, good[~aside], ratios)
    raw = Model((weights * ratios).astype(np.float32), bias, 1.0, 0.0)
    slope, offset = sigmoid_of(np.array([raw.margin(rows[i]) for i in np.flatnonzero(aside)]), good[aside])
    return Model(raw.weights, raw.bias, slope, offset)


def remainder() -> Column:
    """The documents' fold: crc32 of the number as text, modulo 4. NULL for a NULL number."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4


def sample(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``places``, ``good``, ``aside`` of at most ``rows`` labelled documents outside the held-out fold.

    The choice is by a hash of the document's number. Several labels of one
    document count as bad if any is. The chosen numbers are at most ``rows`` and
    therefore broadcast; all texts are scanned once, and only theirs are taken apart.
    """
    chosen = (
        labels.filter(F.col("quality").isNotNull() & (remainder() != 2))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
        .withColumn("aside", remainder() == 3)
    )

    @F.pandas_udf("array<int>")
    def places(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codes = _Codes()
        for texts in batches:
            yield pd.Series([features_of(text, codes) for text in texts])

    # Of rows that repeat a number, a single text counts.
    rows_of = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = rows_of.groupBy("doc_id", "quality", "aside").agg(F.min("text").alias("text"))
    return found.select("doc_id", places("text").alias("places"), (F.col("quality") > 0).alias("good"), "aside")


def learn(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """A model from the bounded sample, fitted on the driver.

    Of the at most ``rows`` sampled texts, in the order of a hash of their number
    and those of more than LONG_TEXT features last, as many are used as have
    SAMPLE_FEATURES features together; the first ones always are.
    """
    taken = stored(sample(documents, labels, rows), "quality-sample")
    # The window runs over numbers and sizes alone, a row per sampled document.
    sizes = taken.select("doc_id", F.size("places").alias("size"))
    order = Window.orderBy(F.col("size") > LONG_TEXT, F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
    used = before.filter(F.col("before") < SAMPLE_FEATURES).select("doc_id")
    kept = taken.join(F.broadcast(used), "doc_id", "left_semi").select("places", "good", "aside", "doc_id").toArrow()
    order = np.lexsort([kept["doc_id"].to_numpy()])
    good, aside = (np.array(kept[c].to_pylist(), bool)[order] for c in ("good", "aside"))
    rows_ = [kept["places"][int(i)].values.to_numpy() for i in order]
    return fit(rows_, good, aside)


def score(text: Column, spark, model: Model) -> Column:
    """Probability that a text is good."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codes, model = _Codes(), shared.value
        for texts in batches:
            yield pd.Series([model.score(features_of(text, codes)) for text in texts], dtype="float64")

    return scores(text)


def with_quality(documents: DataFrame, labels: DataFrame, name: str = "score", rows: int = SAMPLE_ROWS) -> DataFrame:
    """``documents`` with the column ``name``: the probability of label 1, from the text alone.

    NULL and empty texts get the score of a text without features. Repeated rows
    get equal scores. Labels that are NULL, or whose document is missing, are not
    used; without labels of both classes every score is the smoothed share of
    good labels (0.5 without any). Other columns pass through; ``name`` replaces a
    column of that name.
    """
    spark = bounded_batches(documents.sparkSession)
    model = learn(documents, labels, rows)
    return documents.withColumn(name, score(F.col("text"), spark, model))
