"""SentencePiece models encoded and decoded by the tokenizers library."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import bounded_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Characters encoded at once; the pieces of so many are in memory together.
CHARACTERS = 1 << 19
SPACE = "▁"
# Threads that encode a batch; more where a task is given more cores.
THREADS = 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
CODED = "struct<ids:array<int>,decoded:string,parity:boolean>"


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protobuf message: varints and fixed words as numbers or bytes."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            octet = data[at]
            value |= (octet & 127) << shift
            at, shift = at + 1, shift + 7
            if octet < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
            yield key >> 3, value
            continue
        if kind == 2:
            size, at = varint(at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
        else:
            raise ValueError(f"protobuf wire type {kind} is not used by these models")
        if at + size > len(data):
            raise ValueError("the model ends inside a field")
        yield key >> 3, data[at : at + size]
        at += size


@dataclass(frozen=True)
class Model:
    """What a model file says: pieces by id, and how text is normalised."""

    pieces: list[tuple[str, float, int]]
    algorithm: int
    byte_fallback: bool
    unknown: int
    charsmap: bytes
    dummy_prefix: bool
    trims_spaces: bool
    escapes_spaces: bool
    space_last: bool


def parse(data: bytes) -> Model:
    """The parts of a model's protobuf that decide how text is encoded."""
    pieces, trainer, normalizer = [], {}, {}
    for number, value in fields(data):
        if number == 1:
            own = dict(fields(value))
            score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            pieces.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            normalizer = dict(fields(value))
    unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), None)
    if unknown is None:
        raise ValueError("the model has no unknown piece")
    return Model(
        pieces=pieces,
        algorithm=trainer.get(3, UNIGRAM),
        byte_fallback=bool(trainer.get(35, 0)),
        unknown=unknown,
        charsmap=normalizer.get(2, b""),
        dummy_prefix=bool(normalizer.get(3, 1)),
        trims_spaces=bool(normalizer.get(4, 1)),
        escapes_spaces=bool(normalizer.get(5, 1)),
        space_last=bool(trainer.get(24, 0)),
    )


def merges_of(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Every way to join two pieces into a third, by the score of the third and then by ids."""
    ids = {piece: i for i, (piece, _, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
    splits = (
        (-pieces[i][1], ids[piece[:at]], ids[piece[at:]])
        for piece, i in ids.items()
        for at in range(1, len(piece))
        if piece[:at] in ids and piece[at:] in ids
    )
    return [(pieces[a][0], pieces[b][0]) for _, a, b in sorted(splits)]


def rebuild(model: Model):
    """A ``tokenizers.Tokenizer`` that does what the model does."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    if model.algorithm not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    if model.space_last:
        raise ValueError("models that mark spaces at the end of a word are not supported")
    if model.algorithm == BPE:
        core = models.BPE(
            vocab={piece: i for i, (piece, _, _) in enumerate(model.pieces)},
            merges=merges_of(model.pieces),
            unk_token=model.pieces[model.unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    else:
        # Pieces that no text may match get a space in front, which escaped text does not have.
        scored = [(piece if kind in (NORMAL, USER, BYTE) else f" {piece}", score) for piece, score, kind in model.pieces]
        core = models.Unigram(scored, unk_id=model.unknown, byte_fallback=model.byte_fallback)
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.trims_spaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    mark = SPACE if model.escapes_spaces else " "
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(mark))
    steps.append(normalizers.Replace(" ", mark))
    tokenizer.normalizer = normalizers.Sequence(steps)
    # The original drops the space that it put before a text, or all in front where it trims.
    drops = (1 << 20) * model.trims_spaces or int(model.dummy_prefix)
    back = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence(back + [decoders.Strip(" ", drops, 0)] * bool(drops))
    own = [AddedToken(piece, normalized=False) for piece, _, kind in model.pieces if kind == USER]
    if own:
        tokenizer.add_tokens(own)
    return tokenizer


class Codec:
    """A model rebuilt, with the original library beside it to verify parity.

    Whole texts go through the rebuilt tokenizer in multithreaded batches, and its
    ids are the result. The original encodes the same whole texts and is only
    compared with it: it settles ties between equal pieces by place, which ranks of
    merges cannot express, so a model may have texts on which the two differ.
    """

    def __init__(self, data: bytes, threads: int = THREADS) -> None:
        # Read when the library first makes its threads, in this worker process.
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        from sentencepiece import SentencePieceProcessor

        self.threads = threads
        self.model = parse(data)
        self.tokenizer = rebuild(self.model)
        self.original = SentencePieceProcessor(model_proto=data)
        self.bytes = [
            bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(SPACE, " ").encode()
            for piece, _, kind in self.model.pieces
        ]

    def code(self, texts: list[str]) -> list[tuple[np.ndarray, str, bool]]:
        """Ids, the text they stand for, and whether both libraries agree, for each text."""
        own = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        original = self.original.encode(texts, num_threads=self.threads)
        return [(np.array(ids, np.int32), self._text(ids), ids == other) for ids, other in zip(own, original)]

    def _text(self, ids: list[int]) -> str:
        """The text of ids, from the bytes of their pieces."""
        try:
            return self._stripped(b"".join(map(self.bytes.__getitem__, ids)).decode())
        except UnicodeDecodeError:
            return self.decode([ids])[0]

    def _stripped(self, decoded: str) -> str:
        if self.model.trims_spaces:
            return decoded.lstrip(" ")
        return decoded.removeprefix(" ") if self.model.dummy_prefix else decoded

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)

    def normalised(self, text: str) -> str:
        """What decoding gives back: the text as the model normalises it."""
        return self._stripped(self.tokenizer.normalizer.normalize_str(text).replace(SPACE, " "))


@lru_cache(maxsize=4)
def codec(data: bytes, threads: int = THREADS) -> Codec:
    """Built once per model and worker process."""
    return Codec(data, threads)


def portions(texts: list[str | None]) -> Iterator[list[int]]:
    """Places of the texts that are there, in portions of bounded size."""
    portion, size = [], 0
    for i, text in enumerate(texts):
        if text is None:
            continue
        if portion and size + len(text) > CHARACTERS:
            yield portion
            portion, size = [], 0
        portion.append(i)
        size += len(text)
    if portion:
        yield portion


def _model(spark, path: str) -> tuple:
    with open(path, "rb") as file:
        data = file.read()
    return spark.sparkContext.broadcast(data), max(THREADS, int(spark.sparkContext.getConf().get("spark.task.cpus", "1")))


def coded(text: Column, spark, path: str = MODEL) -> Column:
    """``ids``, ``decoded`` and ``parity`` of whole texts, as one struct column."""
    shared, threads = _model(spark, path)

    @F.pandas_udf(CODED)
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(shared.value, threads)
        for batch in batches:
            texts = [None if text is None else str(text) for text in batch]
            out: list[tuple] = [(None, None, None)] * len(texts)
            for portion in portions(texts):
                for i, coded_text in zip(portion, own.code([texts[i] for i in portion])):
                    out[i] = coded_text
            yield pd.DataFrame(out, columns=["ids", "decoded", "parity"], dtype=object)

    return both(text)


def decode(ids: Column, spark, path: str = MODEL) -> Column:
    """The texts of arrays of ids; NULL for NULL."""
    shared, threads = _model(spark, path)

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(shared.value, threads)
        for batch in batches:
            there = [i for i, ids in enumerate(batch) if ids is not None]
            out: list[str | None] = [None] * len(batch)
            for i in there:
                out[i] = own.decode([[int(x) for x in batch.iloc[i]]])[0]
            yield pd.Series(out, dtype=object)

    return texts(ids)


def with_pieces(documents: DataFrame, path: str = MODEL, name: str = "pieces") -> DataFrame:
    """``documents`` with ``name``: a struct of ``ids``, ``decoded`` and ``parity`` of the whole ``text``.

    ``ids`` are the piece ids that the rebuilt tokenizer gives, ``decoded`` is the
    text they stand for (the text as the model normalises it), ``parity`` says
    whether the original library gives the same ids for the whole text. A NULL text has NULL in all three, an empty one no ids.
    Text that looks like a control piece is ordinary text. Repeated rows get equal
    results; other columns pass through, and ``name`` replaces one of that name.
    """
    spark = bounded_batches(documents.sparkSession)
    return documents.withColumn(name, coded(F.col("text"), spark, path))
