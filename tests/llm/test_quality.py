from __future__ import annotations

from zlib import crc32

import numpy as np
import pytest

from martloom.llm import quality as Q
from martloom.llm.catalogue import op5_quality

SCHEMA = "doc_id long, text string, score string, places string"


def test_dual_descent_reaches_the_optimum_of_the_primal():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 12, 5)).astype(np.int32) for _ in range(40)]
    good = rng.random(40) < 0.5
    ratios = rng.normal(size=Q.PLACES)
    weights, bias = Q.dual_coordinate_descent(rows, good, ratios, c=0.3, rounds=4000)
    dense = np.zeros((40, 13))
    for i, p in enumerate(rows):
        dense[i, p], dense[i, 12] = ratios[p] / len(p) ** 0.5, 1.0
    y, share = np.where(good, 1.0, -1.0), good.mean()
    cost = np.where(good, 0.15 / share, 0.15 / (1 - share))
    value = lambda w: 0.5 * w @ w + (cost * np.maximum(0, 1 - y * (dense @ w))).sum()
    found = np.concatenate([weights[:12], [bias]])
    best = value(found)
    assert all(value(found + rng.normal(scale=10.0 ** -rng.integers(1, 5), size=13)) >= best - 2e-3 for _ in range(3000))


def test_ratios_and_features_by_hand():
    rows, good = [np.array([1, 2]), np.array([2]), np.array([3])], np.array([True, True, False])
    ratios = Q.log_count_ratios(rows, good)
    n = Q.PLACES
    assert ratios[2] == pytest.approx(np.log((3 / (n + 3)) / (1 / (n + 1))))
    codes = Q._Codes()
    text = "A b, b! c"
    assert set(Q.features_of(text, codes)) == set(Q.features_of(text.lower(), codes))
    assert len(Q.features_of("a b", codes)) == 3 and len(Q.features_of("", codes)) == len(Q.features_of(None, codes)) == 0
    assert set(Q.features_of("a a a", codes)) < set(Q.features_of("a " * 40, codes))


def test_held_out_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    got = op5_quality(spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in got.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 for d, r in rows.items())
    assert all(r.predicted == int(r.score >= 0.7) for r in rows.values())
    held = [(rows[d].predicted, q) for d, q in labels.items() if rows[d].held_out]
    for q in (0, 1):
        assert np.mean([p == q for p, label in held if label == q]) > 0.95


def test_held_out_labels_are_not_read(spark):
    docs = spark.createDataFrame([(i, f"w{i % 7} x{i % 5}", "", "") for i in range(400)], SCHEMA)
    labels = [(i, int(i % 7 > 2), 0) for i in range(400)]
    turned = [(i, 1 - q if crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels]
    tables = [spark.createDataFrame(x, "doc_id long, quality int, toxic int") for x in (labels, turned)]
    one, two = ({r.doc_id: r.score for r in Q.with_quality(docs, t).collect()} for t in tables)
    assert one == two and len(set(one.values())) > 3


def test_nulls_one_class_and_empty_tables(spark):
    rows = [(1, None, "a", "b"), (2, "", None, None), (None, "x y", "", ""), (3, "x y", "", ""), (3, "x y", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(3, 1, None), (3, None, 1), (None, 0, 0), (77, 0, 0)], "doc_id long, quality int, toxic int")
    got = Q.with_quality(docs, labels)
    assert got.columns == docs.columns
    scores = [r.score for r in got.collect()]
    assert len(scores) == 5 and len(set(scores)) == 1 and 0.5 <= scores[0] < 1
    assert {r.score for r in Q.with_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.with_quality(docs.limit(0), labels).collect() == []


def test_the_bound_on_features_never_leaves_nothing_to_learn_from(spark, monkeypatch):
    long = " ".join(f"t{i}" for i in range(300))
    rows = [(i, f"w{i % 7} x{i % 5}" + (f" {long}{i}" if i % 3 == 0 else ""), "", "") for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 7 > 2), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(Q, "LONG_TEXT", 50)
    monkeypatch.setattr(Q, "SAMPLE_FEATURES", 500)
    scores = {r.doc_id: r.score for r in Q.with_quality(docs, labels).collect()}
    assert len(set(scores.values())) > 3
    monkeypatch.setattr(Q, "SAMPLE_FEATURES", 1)
    assert len(Q.with_quality(docs, labels).collect()) == 300
