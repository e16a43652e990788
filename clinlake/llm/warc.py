"""WARC archives: writing, normalising monolithic gzip, reading by sidecar index.

Pages are written as WARC/1.1 records into archives of one gzip stream each. A payload that occurs more than once
is a response at the smallest page_id and a revisit elsewhere. The normaliser inflates such a whole-file
stream once, front to back, and rewrites every record as a gzip member of its own, with an index of where each
member lies; after that any record can be read, or any range of records shared out, without the rest of the file.

Files go to the shared working folder through its own file system, under names of their own for each attempt
of a task. What counts are the manifest and index tables, which Spark commits, so that what a lost or repeated attempt
leaves behind is never read. A task holds one record and one buffer at a time; an archive ends
once it holds ``ARCHIVE_BYTES`` of records.

Defined results: a null html is an empty payload; payloads under ``SHARED_BYTES`` bytes are always responses; rows that
repeat a page_id with one payload are all responses if theirs is the smallest; a null page_id is written as such,
and never referred to unless no other page has the payload; a null url is empty; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.session import stored, working_folder

SHARED_BYTES = 100
ARCHIVE_BYTES = 64 << 20
_CHUNK = 1 << 20
_LEVEL = 4
#: Records read by one row of work when an index is read.
READ_RECORDS = 256

# The record layout of the WARC/1.1 standard.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"


def with_record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_digest, record_type and refers_to of every page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"),
    ).withColumn("payload_digest", F.sha2("payload", 256))
    digests = rows.filter(F.length("payload") >= SHARED_BYTES)
    shared = digests.groupBy("payload_digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    joined = rows.join(shared.select("payload_digest", "_first"), "payload_digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),  # the payload of a revisit is not written
        F.length("payload").cast("long").alias("payload_bytes"),
        "payload_digest",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("_first")).alias("refers_to"),
    )


def record(row: dict) -> bytes:
    """One WARC record; its block is an HTTP response, of a revisit only the headers."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    if row["record_type"] == "response":
        block += row["payload"]
    page = "null" if row["page_id"] is None else row["page_id"]
    head = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<urn:page:{page}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": quote(row["url"], safe=":/?#[]@!$&'()*+,;=-._~"),
        "WARC-Payload-Digest": f"sha256:{row['payload_digest']}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if row["record_type"] == "revisit":
        head |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<urn:page:{row['refers_to']}>"}
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items())
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


class RecordCutter:
    """Cuts a stream of inflated bytes into whole records."""

    def __init__(self):
        self._held = bytearray()

    def feed(self, data: bytes) -> Iterator[bytes]:
        self._held += data
        at = 0
        while (end := self._end(at)) is not None and end <= len(self._held):
            yield bytes(self._held[at:end])
            at = end
        del self._held[:at]

    def _end(self, at: int) -> int | None:
        """Where the record that begins here ends, None while its head is not whole."""
        head = self._held.find(b"\r\n\r\n", at)
        if head < 0:
            return None
        return head + 4 + int(headers(bytes(self._held[at:head]))["content-length"]) + 4

    def close(self) -> None:
        if self._held.strip():
            raise ValueError(f"the stream ends inside a record, {len(self._held)} bytes into it")


def headers(head: bytes) -> dict[str, str]:
    """Fields by lower-case name; the first line is left out."""
    lines = head.decode().split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines if line)}


def open_folder(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder) if ":/" in folder else (pyarrow.fs.LocalFileSystem(), folder)


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """The manifest, (archive, n_records), of monolithic gzip archives of ``with_record_types`` rows."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        rows = _rows(batches)
        row = next(rows, None)
        while row is not None:
            name, n_records, n_bytes = f"{uuid.uuid4().hex}.warc.gz", 0, 0
            squeeze = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
            with files.open_output_stream(f"{base}/{name}", compression=None) as out:
                while row is not None and n_bytes < ARCHIVE_BYTES:
                    data = record(row)
                    out.write(squeeze.compress(data))
                    n_records, n_bytes = n_records + 1, n_bytes + len(data)
                    row = next(rows, None)
                out.write(squeeze.flush())
            yield pa.RecordBatch.from_pydict({"archive": [name], "n_records": [n_records]})

    return stored(records.mapInArrow(write, "archive string, n_records long"), "warc-manifest")


def normalise(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrites every archive named in column archive; the sidecar index: archive, record_no, start, length.

    The source may be one gzip stream or several one after another.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(source)
        to_files, to_base = open_folder(target)
        to_files.create_dir(to_base, recursive=True)
        for row in _rows(batches):
            name, lengths = f"{uuid.uuid4().hex}.warc.gz", []
            with (
                files.open_input_stream(f"{base}/{row['archive']}", compression=None) as stream,
                to_files.open_output_stream(f"{to_base}/{name}", compression=None) as out,
            ):
                for data in records_of(stream):
                    member = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
                    packed = member.compress(data) + member.flush()
                    out.write(packed)
                    lengths.append(len(packed))
            starts = [0, *accumulate(lengths)][:-1]
            index = {"archive": [name] * len(lengths), "record_no": [*range(len(lengths))], "start": starts, "length": lengths}
            yield pa.RecordBatch.from_pydict(index, schema=_INDEX)

    # One archive is one row of work; what is shuffled are names.
    spread = archives.select("archive").repartition(max(1, archives.sparkSession.sparkContext.defaultParallelism), F.col("archive"))
    return stored(spread.mapInArrow(rewrite, "archive string, record_no long, start long, length long"), "warc-index")


def records_of(stream) -> Iterator[bytes]:
    """The records of a gzip stream, inflated once, a chunk at a time."""
    cutter, inflate = RecordCutter(), zlib.decompressobj(31)
    while data := stream.read(_CHUNK):
        while data:
            yield from cutter.feed(inflate.decompress(data))
            data = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)
    cutter.close()


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Every record an index names, each read by its place: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest (computed from the payload where the record holds one) and payload (null for a revisit)."""
    work = index.groupBy("archive", F.floor(F.col("record_no") / READ_RECORDS).alias("_part")).agg(
        F.min("start").alias("start"), F.sort_array(F.collect_list(F.struct("start", "length"))).alias("members")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        for item in _rows(batches):
            with files.open_input_file(f"{base}/{item['archive']}") as file:
                for first in range(0, len(item["members"]), 32):
                    rows = []
                    for member in item["members"][first : first + 32]:
                        file.seek(member["start"])
                        rows.append(parsed(zlib.decompress(file.read(member["length"]), 31)))
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _READ, strict=True)], schema=_READ)

    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    return work.mapInArrow(read, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of Arrow batches as dictionaries, a few at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, 32):
            yield from batch.slice(first, 32).to_pylist()


_INDEX = pa.schema([("archive", pa.string()), ("record_no", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
_READ = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])


def parsed(data: bytes) -> tuple:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = headers(head)
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    whole = kind == "response"
    if whole and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"record {fields['warc-record-id']} does not hold the payload its digest names")
    return (
        _page(fields["warc-record-id"]),
        unquote(fields["warc-target-uri"]),
        kind,
        None if whole else _page(fields["warc-refers-to"]),
        len(payload) if whole else int(headers(http)["content-length"]),
        digest,
        payload if whole else None,
    )


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "null" else int(number)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to archives, normalised, and read back by the index."""
    spark = pages.sparkSession
    monolithic, normal = working_folder(spark, "warc-monolithic"), working_folder(spark, "warc-normal")
    manifest = write_archives(with_record_types(pages), monolithic)
    return read_records(normalise(manifest, monolithic, normal), normal)
