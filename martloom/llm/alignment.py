"""Tokens of two tokenizers aligned on the bytes of a text, by products of sparse incidence matrices."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.sentencepiece_codec import BYTE, SPACE, parse
from martloom.llm.shared import bounded_batches, stored

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Bytes of text whose incidence matrices are multiplied at once, and of a stored block.
PORTION = 1 << 20
BLOCK = 8 << 20
# Longer texts are encoded in parts, cut where no token of either model reaches across.
PART = 1 << 18
# What a fixed pattern splits text into before merging; part of the byte-level scheme.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Longer runs of white space are left to the library whose pattern matcher does not backtrack.
WHITE = re.compile(r"\s{4096}")


@dataclass(frozen=True)
class Csr:
    """A sparse matrix by rows: the columns of row i are ``columns[start[i]:start[i + 1]]``, all entries one."""

    start: np.ndarray
    columns: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.start) - 1

    @classmethod
    def of_ends(cls, ends: np.ndarray, width: int) -> Csr:
        """Rows that follow one another without a gap: row i holds the columns up to ``ends[i]``."""
        return cls(np.concatenate([[0], ends]), np.arange(width, dtype=np.int64), width)

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(self.height, dtype=np.int64), np.diff(self.start))
        order = np.argsort(self.columns, kind="stable")
        count = np.bincount(self.columns, minlength=self.width)
        return Csr(np.concatenate([[0], np.cumsum(count)]), rows[order], self.height)


def row_products(a: Csr, b: Csr) -> np.ndarray:
    """Per row of ``a``, how many products Gustavson's method forms for it: the size of the rows of ``b`` it meets."""
    met = np.concatenate([[0], np.cumsum(np.diff(b.start)[a.columns])])
    return met[a.start[1:]] - met[a.start[:-1]]


def gustavson(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The product ``a b`` row by row: row and column of every non-zero, and its value.

    Row i of the result is the sum of the rows of ``b`` that row i of ``a`` names.
    """
    rows = np.repeat(np.arange(a.height, dtype=np.int64), np.diff(a.start))
    size = np.diff(b.start)[a.columns]
    offset = np.cumsum(size) - size
    entry = np.arange(int(size.sum())) - np.repeat(offset, size) + np.repeat(b.start[a.columns], size)
    key = np.repeat(rows, size) * max(b.width, 1) + b.columns[entry]
    if len(key) > 1 and (key[1:] < key[:-1]).any():
        key.sort(kind="stable")
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    value = np.diff(np.concatenate([at, [len(key)]]))
    row, column = np.divmod(key[at], max(b.width, 1))
    return row, column, value


def byte_alphabet() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: visible ones stand for themselves, others follow 256."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def parts(text: str) -> Iterator[tuple[int, int]]:
    """Bounds of the parts of a text, each at least ``PART`` long: a later part starts with a space before a letter
    and after a visible character."""
    at, n = 0, len(text)
    while n - at > PART:
        cut = text.find(" ", at + PART)
        while 0 < cut < n - 1 and not (text[cut + 1].isalpha() and text[cut - 1].isalnum()):
            cut = text.find(" ", cut + 1)
        if cut < 0 or cut >= n - 1:
            break
        yield at, cut
        at = cut
    yield at, n


class Pair:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, byte_model: bytes, piece_model: bytes) -> None:
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        own = json.loads(byte_model)["model"]
        alphabet = byte_alphabet()
        entries = {i: bytes(alphabet[c] for c in piece) for piece, i in own["vocab"].items() if all(c in alphabet for c in piece)}
        self.a_bytes = [entries.get(i, b"") for i in range(max(own["vocab"].values()) + 1)]
        self.slow = Tokenizer.from_str(byte_model.decode())
        self.slow.encode_special_tokens = True
        ranks = {entry: i for i, entry in entries.items() if i < 256 + len(own["merges"])}
        self.fast = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.ranked = self._ranked(own, entries)
        self.pieces = SentencePieceProcessor(model_proto=piece_model)
        model = parse(piece_model)
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(SPACE, " ").encode()
            for piece, _, kind in model.pieces
        ]
        # No piece goes on with a mark after another letter, so none reaches over a part's start.
        self.divisible = model.dummy_prefix and not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece, _, _ in model.pieces)
        self.a_size, self.b_size = (np.array([len(x) for x in own], np.int64) for own in (self.a_bytes, self.b_bytes))
        self.names = {}
        for side, count, last in (("a", len(self.a_bytes), b"|"), ("b", len(self.b_bytes), b";")):
            self.names[side] = [np.array([str(i).encode() + end for i in range(count)], object) for end in (b",", last)]

    @staticmethod
    def _ranked(own: dict, entries: dict[int, bytes]) -> bool:
        """Whether merging by the rank of the result is the same as by the list of merges: both in one order."""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in own["merges"]]
        made = [own["vocab"][a + b] for a, b in pairs]
        return made == sorted(set(made)) and made[:1] == [256] and sorted(entries)[: 256 + len(made)] == list(range(256 + len(made)))

    def a_ids(self, text: str) -> np.ndarray:
        """Ids of the byte-level tokenizer; what looks like a special token is plain text."""
        out = []
        for start, end in parts(text):
            part = text[start:end]
            if self.ranked and not WHITE.search(part):
                out.append(np.array(self.fast.encode_ordinary(part), np.int32))
            else:
                out.append(np.array(self.slow.encode(part, add_special_tokens=False).ids, np.int32))
        return out[0] if len(out) == 1 else np.concatenate(out)

    def b_ids(self, text: str) -> np.ndarray:
        """Ids of the piece tokenizer, which puts a space before the text itself."""
        cuts = list(parts(text)) if self.divisible else [(0, len(text))]
        own = [np.array(self.pieces.encode(text[start + (start > 0) : end]), np.int32) for start, end in cuts]
        return own[0] if len(own) == 1 else np.concatenate(own)

    def both(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both, or None if there is no text or either's bytes are not the spaced text's."""
        if not text:
            return None
        spaced = f" {text}"
        whole = spaced.encode("utf-8", "surrogatepass")
        a = self.a_ids(spaced)
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != whole:
            return None
        b = self.b_ids(text)
        if b"".join(map(self.b_bytes.__getitem__, b.tolist())) != whole:
            return None
        return a, b


@lru_cache(maxsize=2)
def pair(byte_model: bytes, piece_model: bytes) -> Pair:
    """Built once per worker process."""
    return Pair(byte_model, piece_model)


@dataclass
class Aligned:
    """Some documents laid end to end: tokens of both sides, the groups they form and the links between them."""

    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    links: tuple[np.ndarray, np.ndarray, np.ndarray]
    # Per document where its tokens and groups start, ends included.
    a_start: np.ndarray
    b_start: np.ndarray
    group_start: np.ndarray


def overlaps(a_end: np.ndarray, b_end: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of the tokens that end at the given bytes: the non-zeros of A·Bᵀ, token-byte incidences of either side.

    Nothing links over a byte in ``common``, so the product is formed between such
    bytes, at least ``PORTION`` of them at a time, whatever the length of a text.
    """
    out, start = [], 0
    while start < (a_end[-1] if len(a_end) else 0):
        stop = common[min(int(np.searchsorted(common, start + PORTION)), len(common) - 1)]
        own = []
        for end in (a_end, b_end):
            lo, hi = np.searchsorted(end, [start, stop], side="right")
            own.append((lo, Csr.of_ends(end[lo:hi] - start, int(stop - start))))
        (a_at, a), (b_at, b) = own
        row, column, value = gustavson(a, b.transposed())
        out.append((row + a_at, column + b_at, value))
        start = stop
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *[x[i] for x in out]]) for i in range(3))


def align(own: Pair, ids: list[tuple[np.ndarray, np.ndarray]]) -> Aligned:
    """Documents lie end to end and share no byte, so no product links tokens of two."""
    none = np.zeros(0, np.int32)
    a, b = (np.concatenate([none, *[x[side] for x in ids]]) for side in (0, 1))
    a_start, b_start = (np.concatenate([[0], np.cumsum([len(x[side]) for x in ids])]).astype(np.int64) for side in (0, 1))
    a_end, b_end = np.cumsum(own.a_size[a]), np.cumsum(own.b_size[b])
    width = int(a_end[-1]) if len(a_end) else 0
    stops = np.zeros(width + 1, np.int8)
    stops[a_end] += 1
    stops[b_end] += 1
    common = np.flatnonzero(stops == 2)
    a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
    before = np.concatenate([[0], a_end])[a_start]
    groups = np.searchsorted(common, before, side="right")
    return Aligned(a, b, a_group, b_group, overlaps(a_end, b_end, common), a_start, b_start, groups)


def group_incidence(group: np.ndarray, groups: int) -> Csr:
    """Tokens by the groups they are in: one group each."""
    return Csr(np.arange(len(group) + 1, dtype=np.int64), group.astype(np.int64), groups)


def group_links(found: Aligned) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links between all tokens that share a group, in portions of bounded size, as products of group incidences."""
    groups = int(found.group_start[-1])
    a, b = group_incidence(found.a_group, groups), group_incidence(found.b_group, groups).transposed()
    ends = np.cumsum(row_products(a, b))
    at = 0
    while at < a.height:
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + PORTION, side="right")))
        rows = Csr(a.start[at : upto + 1] - a.start[at], a.columns[a.start[at] : a.start[upto]], a.width)
        row, column, value = gustavson(rows, b)
        yield row + at, column, value
        at = upto


def _texts(own: Pair, found: Aligned) -> list[str]:
    """Per document the groups written out, ``a,a|b;a|b,b``, as a SHA-256."""
    order, text = [], []
    for side, ids, group in (("a", found.a, found.a_group), ("b", found.b, found.b_group)):
        last = np.concatenate([group[1:] != group[:-1], [True]]) if len(group) else np.zeros(0, bool)
        within, end = own.names[side]
        text.append(np.where(last, end[ids], within[ids]))
        order.append(2 * group + (side == "b"))
    written = np.concatenate(text)[np.argsort(np.concatenate(order), kind="stable")]
    start = found.a_start + found.b_start
    return [
        hashlib.sha256(b"".join(written[i:j].tolist())[:-1]).hexdigest() if j > i else ""
        for i, j in zip(start[:-1].tolist(), start[1:].tolist())
    ]


DETAIL = "a_ids array<int>, b_ids array<int>, a_groups array<int>, b_groups array<int>, link_a array<int>, link_b array<int>, link_bytes array<int>"
# A document with its row of the block's incidence of documents and id pairs; the first
# one of a block carries the block's pairs and how many links hold each.
ROWS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_group_links long, groups_sha256 string, "
    "pair array<int>, times array<int>, pairs array<long>, links array<long>"
)
SHIFT = 32


def _portions(own: Pair, texts: list[str | None]) -> Iterator[tuple[list[int], Aligned]]:
    """Places of the texts that have tokens and their alignment, about ``PORTION`` bytes at a time."""
    places, ids, size = [], [], 0
    for i, text in enumerate(texts):
        found = own.both(text)
        if found is None:
            continue
        places.append(i)
        ids.append(found)
        size += len(text)
        if size >= PORTION:
            yield places, align(own, ids)
            places, ids, size = [], [], 0
    if places:
        yield places, align(own, ids)


def _block(own: Pair, name: int, doc_ids: list, texts: list[str | None]) -> pa.RecordBatch:
    """The rows of a block, as :data:`ROWS`."""
    n = len(texts)
    counts = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_group_links")}
    signs, pieces, rows = [""] * n, [], []
    for places, found in _portions(own, texts):
        at = np.array(places)
        counts["n_a"][at], counts["n_b"][at] = np.diff(found.a_start), np.diff(found.b_start)
        counts["n_groups"][at] = np.diff(found.group_start)
        groups = int(found.group_start[-1])
        a, b = group_incidence(found.a_group, groups), group_incidence(found.b_group, groups).transposed()
        formed = np.concatenate([[0], np.cumsum(row_products(a, b))])
        counts["n_group_links"][at] = np.diff(formed[found.a_start])
        for i, sign in zip(places, _texts(own, found)):
            signs[i] = sign
        row, column, _ = found.links
        pieces.append(found.b[column].astype(np.int64) << SHIFT | found.a[row])
        rows.append(at[np.searchsorted(found.a_start, row, side="right") - 1])
    none = np.zeros(0, np.int64)
    pairs, index = np.unique(np.concatenate([none, *pieces]), return_inverse=True)
    width = max(len(pairs), 1)
    cells, times = np.unique(np.concatenate([none, *rows]) * width + index, return_counts=True)
    row, column = np.divmod(cells, width)
    starts = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())
    columns = {
        "block": pa.array(np.full(n, name, np.int64)),
        "doc_id": pa.array(doc_ids, pa.int64()),
        **{c: pa.array(v) for c, v in counts.items()},
        "groups_sha256": pa.array(signs),
        "pair": pa.ListArray.from_arrays(starts, pa.array(column, pa.int32())),
        "times": pa.ListArray.from_arrays(starts, pa.array(times, pa.int32())),
        "pairs": pa.array([pairs] + [None] * (n - 1), pa.list_(pa.int64())),
        "links": pa.array([np.bincount(index, minlength=len(pairs))] + [None] * (n - 1), pa.list_(pa.int64())),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _models(spark, byte_model: str, piece_model: str):
    data = []
    for path in (byte_model, piece_model):
        with open(path, "rb") as file:
            data.append(file.read())
    return spark.sparkContext.broadcast(tuple(data))


def detailed(documents: DataFrame, byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> DataFrame:
    """Per document both token sequences, each token's group, and the overlap links by token place with shared bytes.

    ``documents`` needs ``doc_id`` and ``text``. A text without tokens (see
    :func:`aligned`) has empty arrays. Repeated rows stay; other columns are not read.
    """
    spark = bounded_batches(documents.sparkSession)
    models = _models(spark, byte_model, piece_model)
    names = [field.split()[0] for field in DETAIL.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pair(*models.value)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = own.both(text)
                found = align(own, [ids] if ids else [])
                values = [found.a, found.b, found.a_group, found.b_group, *found.links]
                lists = [pa.array([v], pa.list_(pa.int32())) for v in values]
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), *lists], ["doc_id", *names])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, f"doc_id long, {DETAIL}")


def aligned(documents: DataFrame, byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> DataFrame:
    """Alignment of whole texts under a byte-level BPE (A) and a piece BPE with byte fallback (B), one row per row.

    ``documents`` needs ``doc_id`` and ``text``. A encodes a space and the text, B
    the text, to which it adds the space itself; special tokens are not used and
    their strings are plain text. Bytes where a token of both ends cut the tokens
    into groups. Every A token is a row of a sparse token-byte matrix, and so is
    every B token; the non-zeros of A·Bᵀ are the links, token occurrences whose
    bytes overlap. The product of the group incidences links tokens that share a
    group; its rows are counted (``n_group_links``), :func:`group_links` forms them.

    Returns ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links
    whose id pair is, of all pairs with its B id, linked most often corpus-wide,
    ties included), ``count_sum`` (over the links, how many links corpus-wide hold
    their id pair), ``groups_sha256`` of the groups' ids, and ``n_group_links``.

    A NULL or empty text, and one whose A or B bytes, joined, are not those of
    space and text, has no tokens: zeros, and an empty ``groups_sha256``. Repeated
    rows each count and stay; a NULL ``doc_id`` stays NULL; other columns are not
    read; an empty table gives an empty result.

    Tokens are encoded once. Documents are kept in blocks of about 8 MiB of text,
    with the id pairs of a block listed once; a shuffle of those lists counts the
    pairs corpus-wide, a second one brings each block the counts of its pairs.
    A frequent pair is one row per block. Only the highest count per B id, one row
    per entry of B's vocabulary, is broadcast.
    """
    spark = bounded_batches(documents.sparkSession)
    models = _models(spark, byte_model, piece_model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = pair(*models.value), TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            ids += batch.column("doc_id").to_pylist()
            texts += batch.column("text").to_pylist()
            size += batch.column("text").nbytes
            if size >= BLOCK:
                yield _block(own, number, ids, texts)
                ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield _block(own, number, ids, texts)

    rows = stored(documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, ROWS), "aligned")
    zipped = F.posexplode(F.arrays_zip("pairs", "links")).alias("at", "p")
    listed = rows.filter(F.col("pairs").isNotNull()).select("block", zipped).select("block", "at", "p.pairs", "p.links")
    counts = stored(listed.groupBy("pairs").agg(F.sum("links").alias("total")), "pair-counts")
    b_id = F.shiftright("pairs", SHIFT)
    highest = counts.groupBy(b_id.alias("b_id")).agg(F.max("total").alias("highest"))
    marked = counts.withColumn("b_id", b_id).join(F.broadcast(highest), "b_id")
    weights = marked.select("pairs", "total", (F.col("total") == F.col("highest")).alias("best"))
    weighed = listed.select(F.col("block").alias("owner"), "at", "pairs").join(weights, "pairs").drop("pairs")
    return rows.drop("pairs", "links").groupBy("block").cogroup(weighed.groupBy("owner")).applyInArrow(_counted, COUNTED)


COUNTED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, n_group_links long"
)


def _counted(documents: pa.Table, weighed: pa.Table) -> pa.Table:
    """The documents of a block, with the counts of its pairs."""
    at = weighed.column("at").to_numpy()
    total, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    total[at], best[at] = weighed.column("total").to_numpy(), weighed.column("best").to_numpy()
    documents = documents.combine_chunks()
    pair_lists, time_lists = (documents.column(c).combine_chunks() for c in ("pair", "times"))
    pairs, times = pair_lists.flatten().to_numpy(), time_lists.flatten().to_numpy().astype(np.int64)
    start = np.concatenate([[0], np.cumsum(pair_lists.value_lengths().to_numpy())])

    def per_document(values: np.ndarray) -> pa.Array:
        return pa.array(np.diff(np.concatenate([[0], np.cumsum(values)])[start]), pa.int64())

    made = {
        "n_links": per_document(times),
        "n_best": per_document(times * best[pairs]),
        "count_sum": per_document(times * total[pairs]),
    }
    names = [field.split()[0] for field in COUNTED.split(", ")]
    return pa.table([made[c] if c in made else documents.column(c) for c in names], names)
