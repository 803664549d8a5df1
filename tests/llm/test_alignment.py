from __future__ import annotations

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from martloom.llm import alignment
from martloom.llm.alignment import BYTE_MODEL, PIECE_MODEL, Csr, Pair, align, aligned, detailed, group_links, gustavson, parts

SCHEMA = "doc_id long, text string, block string, pairs string"


@pytest.fixture(scope="module")
def models():
    with open(BYTE_MODEL, "rb") as a, open(PIECE_MODEL, "rb") as b:
        return a.read(), b.read()


@pytest.fixture(scope="module")
def own(models):
    return Pair(*models)


class Plain:
    """Token by token, with the two libraries alone."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTE_MODEL)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
        with open(BYTE_MODEL) as file:
            vocab = json.load(file)["model"]["vocab"]
        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
        code = {chr(x): x for x in letters}
        code |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in letters)}
        self.a_bytes = {i: bytes(code[c] for c in t) for t, i in vocab.items()}

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(self, text):
        if not text:
            return [], []
        out = []
        a = [(i, self.a_bytes[i]) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, self.b_bytes(i)) for i in self.b.encode(text)]
        for tokens in (a, b):
            if b"".join(t for _, t in tokens) != (" " + text).encode():
                return [], []
            at, own = 0, []
            for i, t in tokens:
                own.append((i, at, at + len(t)))
                at += len(t)
            out.append(own)
        return out

    def rows(self, texts):
        docs, count = [], Counter()
        for text in texts:
            a, b = self.spans(text)
            links = []
            j = 0
            for x, s, e in a:
                while j < len(b) and b[j][2] <= s:
                    j += 1
                k = j
                while k < len(b) and b[k][1] < e:
                    links.append((x, b[k][0]))
                    k += 1
            ends = sorted({e for *_, e in a} & {e for *_, e in b})
            groups, lo = [], 0
            for end in ends:
                groups.append([[x for x, s, e in t if lo <= s and e <= end] for t in (a, b)]) if len(text) < 3000 else groups.append(None)
                lo = end
            docs.append((a, b, groups, links))
            count.update(links)
        best = defaultdict(int)
        for (_, y), n in count.items():
            best[y] = max(best[y], n)
        out = []
        for a, b, groups, links in docs:
            sha = None
            if None not in groups:
                text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
                sha = hashlib.sha256(text.encode()).hexdigest() if a else ""
            n_best = sum(count[x] == best[x[1]] for x in links)
            out.append((len(a), len(b), len(groups), len(links), n_best, sum(count[x] for x in links), sha))
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def test_products_of_sparse_matrices():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n, k, m = rng.integers(1, 9, 3)
        x, y = rng.random((n, k)) < 0.4, rng.random((k, m)) < 0.4

        def csr(z):
            return Csr(np.concatenate([[0], np.cumsum(z.sum(1))]), np.nonzero(z)[1], z.shape[1])

        row, column, value = gustavson(csr(x), csr(y))
        product = np.zeros((n, m), int)
        product[row, column] = value
        assert (product == x.astype(int) @ y.astype(int)).all() and (value > 0).all()
        back = csr(y).transposed()
        assert (back.start == csr(y.T).start).all() and (back.columns == csr(y.T).columns).all()


TEXTS = [
    None,
    "",
    " ",
    "a",
    "Straße und Öl, naïve café",
    "two  spaces\n\nand\ttabs   ",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "a mark ▁ in it",
    "漢字とかな 🙂👩‍👩‍👧 ​\x00end",
    "l'été d'être don't we'll",
    "word " * 3000,
    "x" * 5000,
    " " * 6000 + "end",
]


def test_ids_are_those_of_the_libraries(own, plain):
    assert own.ranked and own.divisible
    for text in TEXTS:
        if text:
            assert own.a_ids(" " + text).tolist() == plain.a.encode(" " + text, add_special_tokens=False).ids
            assert own.b_ids(text).tolist() == plain.b.encode(text)


def test_long_texts_are_encoded_in_parts_without_a_difference(own, plain, monkeypatch):
    monkeypatch.setattr(alignment, "PART", 40)
    monkeypatch.setattr(alignment, "PORTION", 100)
    rng = random.Random(5)
    words = ["don't", "a", "été", "  ", "\n", "x9", "漢字", ".", "word", "Haus-Tür", "9", "▂", "it's ", " \t"]
    for _ in range(60):
        text = " ".join(rng.choice(words) for _ in range(200))
        assert len(list(parts(text))) > 3
        assert own.a_ids(" " + text).tolist() == plain.a.encode(" " + text, add_special_tokens=False).ids
        assert own.b_ids(text).tolist() == plain.b.encode(text)
        found = align(own, [own.both(text)])
        a, b = plain.spans(text)
        links = {(i, j) for i, (_, s, e) in enumerate(a) for j, (_, t, f) in enumerate(b) if s < f and t < e}
        assert set(zip(found.links[0].tolist(), found.links[1].tolist())) == links


def test_group_links_join_all_tokens_of_a_group(own, monkeypatch):
    monkeypatch.setattr(alignment, "PORTION", 7)
    found = align(own, [own.both(t) for t in ("Straße und Öl", "unbelievable tokenisation 漢字とかな")])
    formed = [(i, j) for row, column, _ in group_links(found) for i, j in zip(row.tolist(), column.tolist())]
    expected = [
        (i, j)
        for i, g in enumerate(found.a_group.tolist())
        for j, h in enumerate(found.b_group.tolist())
        if g == h
    ]
    assert sorted(formed) == expected and len(formed) >= len(found.links[0])


def test_edge_texts_repeats_and_clashing_columns(spark, plain):
    texts = TEXTS + TEXTS[3:7]
    table = spark.createDataFrame([(i if i else None, t, "b", "p") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in aligned(table).collect()}
    assert len(got) == len(texts)
    for i, expected in enumerate(plain.rows(texts)):
        r = got[i if i else None]
        found = (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256 if expected[-1] is not None else None)
        assert found == expected, texts[i]
    assert aligned(table.limit(0)).collect() == []
    none = aligned(table.filter("text is null")).collect()
    assert [tuple(r) for r in none] == [(None, 0, 0, 0, 0, 0, 0, "", 0)]


def test_whole_table_against_brute_force(spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 1 << 14)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    docs = table.select("doc_id", "text").collect()
    got = {r.doc_id: r for r in aligned(table).collect()}
    assert len(got) == len(docs)
    for d, expected in zip(docs, plain.rows([d.text for d in docs])):
        r = got[d.doc_id]
        found = (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256 if expected[-1] is not None else None)
        assert found == expected


def test_detail_holds_tokens_groups_and_links(spark, plain):
    texts = ["Straße und Öl", None, "unbelievable"]
    table = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA)
    for r in detailed(table).collect():
        a, b = plain.spans(texts[r.doc_id])
        assert r.a_ids == [x for x, *_ in a] and r.b_ids == [x for x, *_ in b]
        shared = {(i, j): min(e, f) - max(s, t) for i, (_, s, e) in enumerate(a) for j, (_, t, f) in enumerate(b)}
        assert dict(zip(zip(r.link_a, r.link_b), r.link_bytes)) == {k: v for k, v in shared.items() if v > 0}
