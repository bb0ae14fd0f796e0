"""WARC archives of pages: one gzip member per record, copies of a payload as revisits, and a sequential reader.

Each task writes the pages of its partition into archives of its own, under names that no other attempt uses, and
returns their paths; only paths of finished tasks reach the manifest, so an attempt that was lost leaves
files that nobody reads. The reader goes through an archive member by member: it inflates piece by piece, takes
the block by its content length and verifies block and payload digest, so it holds a piece and one header, whatever the
size of an archive or record. Archives lie in the shared folder and are reached through pyarrow's file systems.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cutgrid.functions.sizing import fresh_dir, stage

#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000
#: Compressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
CRAWLED = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PIECE = 1 << 20
_PAGE, _NO_PAGE = "urn:x-page:", "urn:x-page-none:"


class BrokenArchive(ValueError):
    """An archive that does not hold what its headers say."""


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system for a path of the shared folder, and the path in it."""
    for scheme, known in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if uri.startswith(scheme):
            uri = known + uri[len(scheme):]
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def _digest(value: bytes) -> str:
    return "sha1:" + base64.b32encode(value).decode()


def _urn(page: str | None) -> str:
    return f"<{_NO_PAGE}>" if page is None else f"<{_PAGE}{quote(page, safe='')}>"


def _page(urn: str | None) -> str | None:
    if urn is None or urn == f"<{_NO_PAGE}>":
        return None
    if not urn.startswith(f"<{_PAGE}"):
        raise BrokenArchive(f"not a page: {urn}")
    return unquote(urn[len(_PAGE) + 1:-1])


def record(page: str | None, url: str | None, payload: bytes, kind: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record as a gzip member; a revisit has the HTTP header of its page but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page)}", f"WARC-Date: {CRAWLED}",
        f"WARC-Target-URI: {quote(url, safe=''':/?#[]@!$&'()*+,;=%-._~''') if url else _urn(page)[1:-1]}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: {_digest(hashlib.sha1(block).digest())}",
        f"WARC-Payload-Digest: {_digest(hashlib.sha1(payload).digest())}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    parts = [packer.compress("\r\n".join(head).encode() + b"\r\n\r\n"), packer.compress(block), packer.compress(b"\r\n\r\n")]
    return b"".join([*parts, packer.flush()])


def _fields(head: bytes, first: str) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith(first):
        raise BrokenArchive(f"a record begins with {lines[0][:40]!r}")
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


class _Record:
    """One record while its bytes come in: header, block of the stated length, two line ends."""

    def __init__(self, keep: bool):
        self.head, self.rest, self.fields, self.http = b"", b"", None, None
        self.left = self.size = 0
        self.block, self.payload = hashlib.sha1(), hashlib.sha1()
        self.kept: list[bytes] | None = [] if keep else None
        self.begun = b""

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            searched = max(0, len(self.head) - 3)
            self.head += data
            end = self.head.find(b"\r\n\r\n", searched)
            if end < 0:
                return
            self.fields, data = _fields(self.head[:end], "WARC/1."), self.head[end + 4:]
            if not self.fields.get("content-length", "").isdigit():
                raise BrokenArchive("a record without content length")
            self.left = int(self.fields["content-length"])
        own, self.rest = data[:self.left], self.rest + data[self.left:]
        self.left -= len(own)
        self.block.update(own)
        if self.http is None:
            self.begun += own
            end = self.begun.find(b"\r\n\r\n")
            if end < 0:
                return
            self.http, own = _fields(self.begun[:end], "HTTP/"), self.begun[end + 4:]
        self.payload.update(own)
        self.size += len(own)
        if self.kept is not None:
            self.kept.append(own)

    def done(self) -> dict:
        if self.fields is None or self.left or self.rest != b"\r\n\r\n" or self.http is None:
            raise BrokenArchive("a record is shorter or longer than it says")
        kind, wanted = self.fields["warc-type"], self.fields["warc-payload-digest"]
        if _digest(self.block.digest()) != self.fields["warc-block-digest"]:
            raise BrokenArchive("a block does not have its digest")
        if kind == "response" and (_digest(self.payload.digest()) != wanted or self.size != int(self.http["content-length"])):
            raise BrokenArchive("a payload does not have its digest or length")
        return {
            "page": _page(self.fields["warc-record-id"]), "url": self.fields["warc-target-uri"], "record_type": kind,
            "payload_bytes": int(self.http["content-length"]),
            "payload_digest": base64.b32decode(wanted.removeprefix("sha1:")).hex(),
            "refers_to": _page(self.fields.get("warc-refers-to")),
            "payload": b"".join(self.kept) if self.kept is not None and kind == "response" else None,
        }


def records(stream, keep: bool = False, piece: int = _PIECE) -> Iterator[dict]:
    """The records of an archive, one after the other; `stream` has `read(n)`."""
    member, own, data = None, None, stream.read(piece)
    while data:
        if member is None:
            member, own = zlib.decompressobj(31), _Record(keep)
        while data and not member.eof:
            try:
                own.feed(member.decompress(data, piece))
            except zlib.error as error:
                raise BrokenArchive(f"a member cannot be inflated: {error}") from error
            data = member.unused_data if member.eof else member.unconsumed_tail
        if member.eof:
            yield own.done()
            member = None
        data = data or stream.read(piece)
    if member is not None:
        raise BrokenArchive("the archive ends within a member")


def planned(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, record_type, refers_to: which pages are stored, and which only refer to an equal one."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("key", F.sha2("html", 256))
    stored = stage(
        rows.filter(F.octet_length("html") >= least).groupBy("key")
        .agg(F.max("page_id").alias("stored"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies")
    )
    refers = F.col("stored").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("stored"))
    return rows.join(stored, "key", "left").select(
        "page_id", "url", "html", F.when(refers, "revisit").otherwise("response").alias("record_type"),
        F.when(refers, F.col("stored")).alias("refers_to"),
    )


def write(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages; path, records, bytes of each archive, staged.

    One record per row: null html is an empty payload, null urls name the page, null ids are kept as such, repeated rows
    are each written (rows that share the id of the stored page are all responses). An empty table writes no archive.
    """
    folder = folder or fresh_dir(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        out, path, count, size, done = None, None, 0, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    system.create_dir(base, recursive=True)
                    name, count, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    path = f"{folder.rstrip('/')}/{name}"
                    out = system.open_output_stream(f"{base.rstrip('/')}/{name}", compression=None)
                member = record(row["page"], row["url"], row["html"].encode(), row["record_type"], row["refers_to"])
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    done.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["path", "records", "bytes"])

    rows = planned(pages).select(
        F.col("page_id").cast("string").alias("page"), "url", "html", "record_type", F.col("refers_to").cast("string").alias("refers_to")
    )
    return stage(rows.mapInArrow(run, "path string, records long, bytes long"))


def read(archives: DataFrame, page_type: T.DataType, payloads: bool = True) -> DataFrame:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to and, if wanted, payload of every record.

    `archives` has a column `path`. Length and digest are those of the full payload for revisits too. A damaged archive
    fails the job with the path and what is wrong.
    """
    fields = pa.schema([
        ("page", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inner = file_system(path)
                with system.open_input_stream(inner, compression=None) as stream:
                    rows, size = [], 0
                    try:
                        for row in records(stream, payloads):
                            rows.append(row)
                            size += len(row["payload"] or b"") + 500
                            if size > 8 << 20:
                                yield pa.RecordBatch.from_pylist(rows, fields)
                                rows, size = [], 0
                    except BrokenArchive as error:
                        raise BrokenArchive(f"{path}: {error}") from error
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, fields)

    paths = archives.select("path")
    found = paths.repartition(max(1, paths.count())).mapInArrow(
        run, "page string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"
    )
    return found.select(
        F.col("page").cast(page_type).alias("page_id"), "url", "record_type", "payload_bytes", "payload_digest",
        F.col("refers_to").cast(page_type).alias("refers_to"), *(["payload"] if payloads else []),
    )
