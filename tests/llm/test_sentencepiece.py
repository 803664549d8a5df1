from __future__ import annotations

import random
import struct

import pytest
import sentencepiece
from pyspark.sql import functions as F

from martloom.llm import sentencepiece_codec
from martloom.llm.catalogue import op2_sentencepiece
from martloom.llm.sentencepiece_codec import MODEL, Codec, decode, fields, parse, portions, with_pieces

SCHEMA = "doc_id long, text string, pieces string, ids string"


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, value):
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram(fallback=True, trims=True):
    """A small unigram model put together by hand; nothing is trained."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)] * fallback
    words = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "é", "aa"]
    pieces += [(w, -1.0 - (7 * i % 12 + 1.7) ** 0.5, 1) for i, w in enumerate(words)]
    data = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    trainer = field(3, 1) + field(4, len(pieces)) + field(35, int(fallback))
    return data + field(2, trainer) + field(3, field(1, b"identity") + field(4, int(trims)))


def samples():
    rng = random.Random(2)
    out = ["", " ", "a", " a  b ", "abcabcaab é", "😀 abc\n\tb", "▁a", "<s> a </s>", "x\x00y"]
    return out + ["".join(rng.choice("abc é ") for _ in range(n)) for n in (3, 30, 300, 3000)]


@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize("trims", [True, False])
def test_unigram_models_encode_as_the_original(fallback, trims):
    data = unigram(fallback, trims)
    codec, original = Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    assert codec.model.algorithm == 1 and codec.model.byte_fallback == fallback
    for text in samples():
        (ids, decoded, same), = codec.code([text])
        assert same and ids.tolist() == original.encode(text), repr(text)
        if fallback:
            assert decoded == codec.decode([ids.tolist()])[0] == codec.normalised(text) == original.decode(ids.tolist())


def test_byte_pair_model_encodes_as_the_original(spark):
    with open(MODEL, "rb") as file:
        codec = Codec(file.read())
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    texts += [*samples(), "a" * 5000, "==" * 999, "aaaa aa aaa " * 50]
    original = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for i in range(0, len(texts), 100):
        for text, (ids, decoded, same) in zip(texts[i : i + 100], codec.code(texts[i : i + 100])):
            assert same and ids.tolist() == original.encode(text), text[:80]
            assert decoded == codec.decode([ids.tolist()])[0] == text.replace("▁", " ")


def test_ids_come_from_the_rebuilt_tokenizer_and_parity_tells_a_wrong_merge(monkeypatch):
    with open(MODEL, "rb") as file:
        data = file.read()
    text, merges = "another thing that they thought of there", sentencepiece_codec.merges_of
    right = Codec(data).code([text])[0]

    def swapped(pieces):
        order = merges(pieces)
        a, b = order.index(("o", "u")), len(order) - 1
        order[a], order[b] = order[b], order[a]
        return order

    monkeypatch.setattr(sentencepiece_codec, "merges_of", swapped)
    ids, decoded, same = Codec(data).code([text])[0]
    assert right[2] and not same and ids.tolist() != right[0].tolist() and decoded == text


def test_a_text_of_a_megabyte(spark):
    text = "Straße und Öl, naïve café 漢字 " * 40_000
    docs = spark.createDataFrame([(1, text, None, None)], SCHEMA)
    row = with_pieces(docs).select(F.size("pieces.ids").alias("n"), "pieces.parity", (F.col("pieces.decoded") == F.col("text")).alias("same")).first()
    assert row.n == len(sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(text)) and row.parity and row.same


def test_a_model_whose_pieces_span_words_is_encoded_whole():
    data = unigram() + field(1, field(1, "c▁a".encode()) + field(2, -0.5) + field(3, 1))
    codec, original = Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in samples():
        (ids, decoded, same), = codec.code([text])
        assert ids.tolist() == original.encode(text) and decoded == original.decode(ids.tolist())


def test_broken_and_unsupported_models():
    with pytest.raises(ValueError):
        list(fields(field(1, b"abc")[:-1]))
    with pytest.raises(ValueError):
        parse(field(1, field(1, b"a")))
    assert [i for p in portions(["x" * 400_000, None, "y" * 400_000, "", "z"]) for i in p] == [0, 2, 3, 4]


def test_columns_nulls_and_clashing_names(spark):
    rows = [(1, None, "p", "i"), (2, "", None, None), (None, "Hello world", "", ""), (3, "Hello world", "", ""), (3, "ß▁ x", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = with_pieces(docs)
    assert got.columns == docs.columns
    back = got.select("doc_id", "text", "pieces.*", decode(F.col("pieces.ids"), spark).alias("again")).collect()
    original = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in back:
        assert r.ids == (None if r.text is None else original.encode(r.text))
        assert r.decoded == r.again == (None if r.text is None else r.text.replace("▁", " "))
    assert with_pieces(docs.limit(0)).collect() == []


def test_query_over_the_documents(spark):
    sf = "/root/testdata/sf0.001"
    original = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_sentencepiece(spark, sf).collect()
    assert {r.doc_id: r.n_pieces for r in rows} == {d: len(original.encode(t)) for d, t in texts.items()}
    assert all(r.parity and r.round_trip for r in rows) and len(rows) == len(texts)
