from __future__ import annotations

import base64
import hashlib
import io
import struct

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

from martloom.llm import warc as W
from martloom.llm.catalogue import op6_warc
from martloom.llm.oracle import ORACLE_SQL

SCHEMA = "page_id long, url string, html string, digest string, size long, path string"


def plain(rows, least=0):
    firsts = {}
    for page_id, _, html in rows:
        body = (html or "").encode()
        if len(body) >= least and page_id is not None:
            firsts[body] = min(page_id, firsts.get(body, page_id))
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        first = firsts.get(body)
        revisit = first is not None and (page_id is None or page_id > first)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page_id, len(body), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "d", 5, "p") for r in rows], SCHEMA)


ROWS = [
    (5, "http://a/\r\nX: y", "<p>é</p>"), (3, None, "<p>é</p>"), (9, "u", None), (8, "", ""), (None, "u", "<p>é</p>"),
    (None, None, "only here"), (3, "again", "<p>é</p>"), (-4, "u", "x" * 300_000), (7, "u", "WARC/1.1\r\n\r\n\r\n"), (6, "ü", "WARC/1.1\r\n\r\n\r\n"),
]


@pytest.mark.parametrize("least", [0, 9])
def test_round_trip_by_hand(spark, least):
    got = W.archived(table(spark, ROWS), least=least)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(ROWS, least)


def test_payloads_urls_and_rolled_archives(spark):
    manifest = W.write(table(spark, ROWS), roll_bytes=1)
    assert manifest.agg(F.sum("records")).first()[0] == len(ROWS) and manifest.count() >= len(ROWS)
    rows = W.read(manifest).collect()
    bodies = {r.record_id: r for r in rows if r.record_type == "response"}
    assert bytes(bodies["urn:page:-4"].payload) == b"x" * 300_000
    assert bytes(bodies["urn:page:6"].payload) == b"WARC/1.1\r\n\r\n\r\n" and bodies["urn:page:6"].target_uri == "ü"
    assert {r.target_uri for r in rows if r.record_id == "urn:page:5"} == {"http://a/%0D%0AX: y"}
    assert W.archived(table(spark, []).limit(0)).collect() == []


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    expected = con.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({ORACLE_SQL['op6_warc']})").fetchall()
    got = [tuple(r) for r in op6_warc(spark, sf).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr) and len(got) == 250


WORDS = b"http WARC-Type response " * 9


def archive(*records, dictionary=WORDS, packed=False):
    frame = zstandard.compress(dictionary) if packed else dictionary
    compressor = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    return W.dictionary_frame(frame) + b"".join(compressor.compress(r) for r in records)


def test_frames_and_broken_archives():
    good = W.record("response", "urn:page:1", "u", b"body", W.digest_of(b"body"))
    for packed in (False, True):
        skipped = struct.pack("<II", 0x184D2A51, 3) + b"abc"
        frames = list(W.Frames(io.BytesIO(archive(good, packed=packed) + skipped + archive(good)[8 + len(WORDS) :]), "a"))
        assert [data for _, data in frames] == [good, good]
        assert W.parsed(frames[0][1])["payload"] == b"body"
    whole = archive(good, good)
    for cut in (4, 30, len(whole) - 3):
        with pytest.raises(W.WarcError):
            list(W.Frames(io.BytesIO(whole[:cut]), "a"))
    with pytest.raises(W.WarcError):
        list(W.Frames(io.BytesIO(archive(good) + b"garbage here"), "a"))
    for old, new in [
        (b"WARC/1.1", b"WORC/1.1"), (b"body", b"bodyy"), (b"body", b"budy"), (b"Content-Length: 4", b"Content-Length: 5"),
        (b"WARC-Type: response\r\n", b""), (b"WARC-Date", b"WARC-Type"), (b"\r\n\r\nbody\r\n\r\n", b"\r\n\r\nbody"), (b"Content-Length: 4", b"Content-Length: x"),
    ]:
        with pytest.raises(W.WarcError):
            W.parsed(good.replace(old, new))


def test_what_no_reader_takes_is_not_written(tmp_path, monkeypatch):
    monkeypatch.setattr(W, "MOST_BYTES", 5000)
    archive = W.Archive(f"file://{tmp_path}/a", b"dictionary " * 100, 1 << 20)
    list(archive.add(b"x" * 5000))
    with pytest.raises(W.WarcError, match="no reader takes"):
        list(archive.add(b"x" * 5001))
