"""WARC archives compressed record by record with Zstandard and a shared dictionary."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import bounded_batches, stored
from martloom.session import work_dir

DICTIONARY_FRAME = 0x184D2A5D
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_FRAME = 0xFD2FB528
DICTIONARY_BYTES = 64 << 10
# The dictionary is trained on the beginnings of at most so many payloads; it
# decides how small records get, never what is in them.
SAMPLE_ROWS, SAMPLE_BYTES = 2_000, 8 << 10
# Compressed bytes after which an archive is closed and the next one begun.
ROLL_BYTES = 64 << 20
LEAST_PAYLOAD = 0
DATE = "2000-01-01T00:00:00Z"
_CHUNK = 1 << 16
# The largest record that is written or read; a longer one is an error, not a cut.
MOST_BYTES = 1 << 30

MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
RECORDS = pa.schema(
    [
        ("path", pa.string()),
        ("position", pa.int64()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


class WarcError(ValueError):
    """An archive that does not say what it should."""


def digest_of(payload: bytes) -> str:
    """Base32 of the SHA-1, in capitals and without padding."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _value(text: str | None) -> str:
    """A header value: control characters, which could end a line, in percent form."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", text or "")


def record(kind: str, record_id: str, uri: str | None, payload: bytes, digest: str, refers_to: str | None = None) -> bytes:
    """One record. A revisit has the HTTP header of its payload, but not the payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_value(uri)}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <{refers_to}>")
    return "\r\n".join([*lines, "", ""]).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary


class Frames:
    """The frames of an archive one after another, in memory one at a time."""

    def __init__(self, file: BinaryIO, name: str) -> None:
        self.file, self.name, self.rest, self.position = file, name, b"", 0
        head = self._peek(8)
        dictionary = None
        if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_FRAME:
            dictionary = self._take(8 + struct.unpack("<I", head[4:])[0])[8:]
            if dictionary[:4] == struct.pack("<I", _FRAME):
                dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
        self.decompressor = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        )

    def _peek(self, n: int) -> bytes:
        while len(self.rest) < n and (more := self.file.read(_CHUNK)):
            self.rest += more
        return self.rest[:n]

    def _take(self, n: int) -> bytes:
        data = self._peek(n)
        if len(data) < n:
            raise WarcError(f"{self.name}: ends at {self.position + len(data)}, inside a frame")
        self.rest, self.position = self.rest[n:], self.position + n
        return data

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        """Position and content of every frame that holds a record."""
        while head := self._peek(8):
            magic = struct.unpack("<I", head[:4])[0] if len(head) == 8 else None
            if magic in _SKIPPABLE:
                self._take(8 + struct.unpack("<I", head[4:])[0])
                continue
            if magic != _FRAME:
                raise WarcError(f"{self.name}: no frame begins at {self.position}")
            yield self.position, self._frame()

    def _frame(self) -> bytes:
        inflater, parts, size = self.decompressor.decompressobj(), [], 0
        while not inflater.eof:
            data, self.rest = self.rest or self.file.read(_CHUNK), b""
            if not data:
                raise WarcError(f"{self.name}: ends inside the frame at {self.position}")
            try:
                parts.append(inflater.decompress(data))
            except zstandard.ZstdError as error:
                raise WarcError(f"{self.name}: broken frame at {self.position}: {error}") from error
            size += len(parts[-1])
            if size > MOST_BYTES:
                raise WarcError(f"{self.name}: the record at {self.position} is longer than {MOST_BYTES} bytes")
            self.rest = inflater.unused_data
            self.position += len(data) - len(self.rest)
        return b"".join(parts)


def _header(data: bytes, first: str) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and what follows the empty line."""
    head, gap, body = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not gap or not lines[0].startswith(first):
        raise WarcError(f"no {first} header")
    out = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip() or name.lower() in out:
            raise WarcError(f"bad header line {line[:80]!r}")
        out[name.lower()] = value.strip()
    return out, body


def _length(fields: dict[str, str]) -> int:
    value = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]+", value):
        raise WarcError(f"bad Content-Length {value[:40]!r}")
    return int(value)


def parsed(data: bytes) -> dict:
    """The fields of a record, after checking its headers, lengths and payload digest."""
    fields, rest = _header(data, "WARC/1.")
    size = _length(fields)
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"Content-Length is {size}, but {len(rest) - 4} bytes and an end follow")
    for name in ("warc-type", "warc-record-id", "warc-date"):
        if not fields.get(name):
            raise WarcError(f"no {name}")
    kind = fields["warc-type"]
    out = {
        "record_type": kind,
        "record_id": fields["warc-record-id"].strip("<>"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
        "payload_bytes": size,
        "payload_digest": None,
        "payload": rest[:size],
    }
    if fields.get("content-type", "").startswith("application/http"):
        http, payload = _header(rest[:size], "HTTP/")
        out["payload_bytes"] = _length(http)
        if kind == "response" and len(payload) != out["payload_bytes"] or kind == "revisit" and payload:
            raise WarcError(f"the HTTP header says {out['payload_bytes']} bytes, the record has {len(payload)}")
        out["payload"] = payload
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "revisit":
        if not said or not out["refers_to"]:
            raise WarcError("a revisit without digest or target")
        out["payload_digest"], out["payload"] = said, None
    else:
        out["payload_digest"] = digest_of(out["payload"])
        if said and said != out["payload_digest"]:
            raise WarcError(f"the payload's digest is {out['payload_digest']}, the header says {said}")
    return out


def page_uri(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def page_number(uri: Column) -> Column:
    """The page number in a record's name; NULL for a page that has none."""
    return F.nullif(F.regexp_extract(uri, r"^urn:page:(-?\d*)$", 1), F.lit("")).cast("long")


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from the bounded sample; plain sample text where training finds too little.

    The pages are chosen by number, and only those chosen send the beginning of a payload.
    """
    numbers = pages.select("page_id").filter("page_id IS NOT NULL").distinct()
    chosen = numbers.orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_ROWS)
    begin = F.substring(F.encode(F.coalesce("html", F.lit("")), "utf-8"), 1, SAMPLE_BYTES)
    # At most SAMPLE_ROWS numbers are broadcast, and a beginning for each comes back.
    begun = pages.join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min(begin).alias("begin"))
    rows = sorted((r.page_id, bytes(r.begin)) for r in begun.collect())
    samples = [record("response", page_uri(number), "", payload, "") for number, payload in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(samples) or record("response", "urn:page:", "", b"", ""))[-DICTIONARY_BYTES:]


def decided(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """``page_id``, ``url``, ``html`` and ``first_id``: the page with an equal payload that this one revisits, or NULL.

    Digests are grouped without their payloads, and their smallest pages written;
    a page is then joined with its digest's smallest page. A digest shared by very
    many pages is one row on one side, and adaptive execution splits the other,
    as both come straight from a shuffle.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    digested = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size"))
    firsts = stored(digested.filter(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("least_id")), "digests")
    revisits = F.col("least_id").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("least_id")))
    found = digested.join(firsts, "digest", "left")
    return found.select(
        "page_id", "url", "html", F.when(revisits & (F.col("size") >= least), F.col("least_id")).alias("first_id")
    )


class Archive:
    """Archives of one task attempt. Their names are its own, so attempts never share a file."""

    def __init__(self, folder: str, dictionary: bytes, roll_bytes: int) -> None:
        self.files, self.folder = fs.FileSystem.from_uri(folder)
        self.uri, self.attempt, self.n, self.roll_bytes = folder.rstrip("/"), uuid.uuid4().hex, 0, roll_bytes
        self.frame = dictionary_frame(dictionary)
        self.compressor = zstandard.ZstdCompressor(
            level=6, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True, write_content_size=True
        )
        self.out = None

    def add(self, data: bytes) -> Iterator[dict]:
        if len(data) > MOST_BYTES:
            raise WarcError(f"a record of {len(data)} bytes; no reader takes more than {MOST_BYTES}")
        if self.out is None:
            self.name = f"{self.attempt}-{self.n:05}.warc.zst"
            self.files.create_dir(self.folder, recursive=True)
            self.out, self.records, self.n = self.files.open_output_stream(f"{self.folder}/{self.name}"), 0, self.n + 1
            self.out.write(self.frame)
            self.bytes = len(self.frame)
        frame = self.compressor.compress(data)
        self.out.write(frame)
        self.records, self.bytes = self.records + 1, self.bytes + len(frame)
        if self.bytes >= self.roll_bytes:
            yield from self.close()

    def close(self) -> Iterator[dict]:
        if self.out is not None:
            self.out.close()
            self.out = None
            yield {"path": f"{self.uri}/{self.name}", "records": self.records, "bytes": self.bytes}


def write(
    pages: DataFrame, folder: str | None = None, least: int = LEAST_PAYLOAD, roll_bytes: int = ROLL_BYTES
) -> DataFrame:
    """Write a record per page to archives in a shared folder; returns ``path``, ``records``, ``bytes`` of each archive.

    Each task writes archives of its own and reports them; the report is a
    written table, so archives that a lost or repeated attempt left behind are in
    no report and are never read.
    """
    spark = bounded_batches(pages.sparkSession)
    target = folder or work_dir(spark, "warc")
    dictionary = spark.sparkContext.broadcast(train_dictionary(pages))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, closed = Archive(target, dictionary.value, roll_bytes), []
        for batch in batches:
            for page_id, url, html, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "first_id"))):
                payload = (html or "").encode("utf-8", "surrogatepass")
                kind = "response" if first is None else "revisit"
                refers = None if first is None else page_uri(first)
                closed += out.add(record(kind, page_uri(page_id), url, payload, digest_of(payload), refers))
        closed += out.close()
        yield pa.RecordBatch.from_pylist(closed, MANIFEST)

    written = decided(pages, least).mapInArrow(archive, "path string, records long, bytes long")
    return stored(written, "warc-manifest")


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives named in the column ``path``, one row each.

    Returns ``path``, ``position`` of the frame, ``record_type``, ``record_id``,
    ``target_uri``, ``refers_to``, ``payload_bytes``, ``payload_digest`` and, if
    asked for, ``payload``. A frame, header, length or digest that is wrong raises
    ``WarcError`` with archive and position. Archives are streamed and dealt to
    tasks; a record is in memory once.
    """
    count = archives.count()
    paths = archives.select("path").repartition(max(1, min(count, 20_000)))
    schema = pa.schema([f for f in RECORDS if payloads or f.name != "payload"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield from _batches(path, schema)

    ddl = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'binary' if f.type == pa.binary() else 'string'}" for f in schema)
    return paths.mapInArrow(records, ddl)


def _batches(path: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    files, name = fs.FileSystem.from_uri(path)
    rows, size = [], 0
    with files.open_input_stream(name) as file:
        for position, data in Frames(file, path):
            try:
                own = parsed(data)
            except WarcError as error:
                raise WarcError(f"{path}: record at {position}: {error}") from error
            rows.append({"path": path, "position": position} | {k: own[k] for k in schema.names if k in own})
            size += len(data) if "payload" in schema.names else 256
            if size > 4 << 20:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def archived(pages: DataFrame, folder: str | None = None, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Write the pages and read them back: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    Of pages with equal payloads of at least ``least`` bytes, the one with the
    smallest ``page_id`` is a response, the others revisit it; all smaller ones are
    responses. NULL html is an empty payload, a NULL url leaves its header out.
    Rows that repeat the smallest ``page_id`` are all responses. A NULL ``page_id``
    counts as larger than any other and stays NULL. Other columns are not read; an
    empty table gives no archive and no row.
    """
    found = read(write(pages, folder, least), payloads=False)
    return found.select(
        page_number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_number(F.col("refers_to")).alias("refers_to"),
    )
