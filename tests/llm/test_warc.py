"""WARC archives: round trip, normaliser, index."""

import gzip
import hashlib
import io
import zlib

import pytest

from clinlake.llm import warc
from clinlake.session import working_folder


def test_round_trip_of_odd_pages(spark):
    same = "<p>" + "é" * 60
    rows = [
        (5, "http://a/ b", same, 1), (3, None, same, 1), (9, "x\r\ny", same, 1), (1, "u", None, 1), (2, "u", "", 1), (4, "u", "short", 1),
        (6, "u", "short", 1), (7, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 9, 1), (8, "u", "z" * 3_000_000, 1), (3, None, same, 1),
        (None, "n", same, 1), (None, "n", "q" * 200, 1),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type int")
    found = warc.round_trip(pages).collect()
    assert len(found) == len(rows)
    by_key = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.url) for r in found), key=str)
    expected = []
    for page_id, url, html, _ in rows:
        raw = (html or "").encode()
        kind, refers = ("response", None) if html != same or page_id == 3 else ("revisit", 3)
        expected.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), kind, refers, url or ""))
    assert by_key == sorted(expected, key=str)
    assert {bytes(r.payload) for r in found if r.page_id == 8} == {b"z" * 3_000_000}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_every_member_is_a_record_at_its_place(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"{k}" * 300) for k in range(40)], "page_id long, url string, html string")
    first, second = working_folder(spark, "a"), working_folder(spark, "b")
    manifest = warc.write_archives(warc.with_record_types(pages), first)
    files, base = warc.open_folder(first)
    for row in manifest.collect():
        with files.open_input_stream(f"{base}/{row.archive}", compression=None) as stream:
            whole = zlib.decompressobj(31)
            whole.decompress(stream.read())
            assert whole.eof and not whole.unused_data  # one stream for the whole file
    index = warc.normalise(manifest, first, second)
    assert index.count() == 40
    files, base = warc.open_folder(second)
    for row in index.collect():
        with files.open_input_file(f"{base}/{row.archive}") as file:
            file.seek(row.start)
            data = gzip.decompress(file.read(row.length))
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")


def test_streams_are_read_whole_or_refused():
    row = {"page_id": 1, "url": "u", "payload": b"abc", "payload_bytes": 3, "payload_digest": "d", "record_type": "response"}
    data = warc.record(row)
    several = gzip.compress(data + data) + gzip.compress(data)
    assert list(warc.records_of(io.BytesIO(several))) == [data] * 3
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.records_of(io.BytesIO(gzip.compress(data[:-9]))))


def test_archives_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    pages = spark.createDataFrame([(k, "u", f"{k}" * 300) for k in range(12)], "page_id long, url string, html string").coalesce(1)
    assert warc.round_trip(pages).count() == 12
