"""WARC archives: one gzip member per record, written and read back by tasks.

Pages with equal payloads are stored once: one of them is the response, the others are
revisit records that point to it. The reader is sequential: it inflates one gzip member at a
time from a stream, frames the block by Content-Length and verifies block and payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapledger.sources.shared import new_folder, write_once

#: Bytes after which an archive is closed and the next one begun.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 16
#: Schemes of Hadoop's file systems that Arrow knows by another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


class WarcError(ValueError):
    """An archive that does not follow the format, or whose digests do not match."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers.get("warc-type", "")

    def http(self) -> tuple[dict[str, str], bytes]:
        """Header lines and payload of a block that holds an HTTP response."""
        head, found, payload = self.block.partition(b"\r\n\r\n")
        if not found:
            raise WarcError("no end of the HTTP headers")
        return fields(head.split(b"\r\n")[1:]), payload


def digest(data: bytes) -> str:
    """SHA-1 in upper-case base 32, as WARC digests are written."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError(f"not a header line: {line[:80]!r}")
        out[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    return out


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, key)}>"


def write_record(headers: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """One record as a gzip member of its own."""
    lines = [*headers, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


class _Members:
    """Inflates a stream of gzip members; ``read`` never goes beyond the member at hand."""

    def __init__(self, stream):
        self.stream, self.rest, self.text = stream, b"", bytearray()
        self.packer = None

    def begin(self) -> bool:
        """Starts the next member; False at the end of the stream."""
        self.rest = self.rest or self.stream.read(CHUNK)
        self.packer, self.text = zlib.decompressobj(31), bytearray()
        return bool(self.rest)

    def more(self) -> bool:
        """Inflates some more of the member; False at its end."""
        if self.packer.eof:
            return False
        data = self.packer.unconsumed_tail or self.rest or self.stream.read(CHUNK)
        if not data:
            raise WarcError("the archive ends inside a record")
        taken_from_tail = bool(self.packer.unconsumed_tail)
        try:
            self.text += self.packer.decompress(data, 16 * CHUNK)
        except zlib.error as error:
            raise WarcError(f"not a gzip member: {error}") from None
        if self.packer.eof:
            self.rest = self.packer.unused_data
        elif not taken_from_tail:
            self.rest = b""
        return True

    def until(self, mark: bytes) -> bytes:
        at = 0
        while (found := self.text.find(mark, at)) < 0:
            at = max(0, len(self.text) - len(mark) + 1)
            if not self.more():
                raise WarcError("no end of the record's headers")
        out = bytes(self.text[:found])
        del self.text[: found + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.text) < n:
            if not self.more():
                raise WarcError("a record is shorter than its Content-Length")
        out = bytes(self.text[:n])
        del self.text[:n]
        return out

    def finish(self) -> None:
        while self.more():
            pass
        if self.text:
            raise WarcError("text behind the end of a record")


def read_records(stream) -> Iterator[Record]:
    """Records of an archive in order; only one of them is held. Digests are verified."""
    members = _Members(stream)
    while members.begin():
        version, *lines = members.until(b"\r\n\r\n").split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise WarcError(f"not a WARC record: {version[:40]!r}")
        headers = fields(lines)
        if not headers.get("content-length", "").isdigit():
            raise WarcError("no Content-Length")
        block = members.take(int(headers["content-length"]))
        if members.take(4) != b"\r\n\r\n":
            raise WarcError("no blank lines behind the block")
        members.finish()
        record = Record(headers, block)
        expected = headers.get("warc-block-digest", "").removeprefix("sha1:")
        if expected and expected != digest(block):
            raise WarcError(f"block digest of {headers.get('warc-record-id')} differs")
        expected = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        if expected and record.kind == "response" and expected != digest(record.http()[1]):
            raise WarcError(f"payload digest of {headers.get('warc-record-id')} differs")
        yield record


def page_record(
    page_id: int | None, url: str | None, payload: bytes | None, size: int, sha1: bytes, refers_to: int | None, name: str | None = None
) -> bytes:
    """A response with its payload or, with ``refers_to``, a revisit without it.

    ``name`` is what the record's id is made of; a place in an archive, as page ids may be null or repeat.
    """
    key = "" if page_id is None else str(page_id)
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(name or f"page:{key}")),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1).decode()),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if page_id is not None:
        headers.append(("X-Page-Id", key))
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("X-Refers-To-Page", str(refers_to))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return write_record(headers, http + (payload if refers_to is None else b""))


def with_origin(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, sha1 and refers_to (null: it is stored as a response).

    Of equal payloads of at least ``min_bytes`` bytes the greatest page_id is the origin. Rows that
    repeat the origin's page_id are responses too, as are rows without page_id in a group that has none.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.unhex(F.sha1("payload")).alias("sha1")
    )
    # one row per task and payload is shuffled, however many pages share it
    origins = rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("sha1").agg(F.max("page_id").alias("origin"), F.count("*").alias("n"))
    origins = origins.filter("n > 1").select("sha1", "origin")
    # Spark splits the partition of a payload that very many pages share
    joined = rows.join(origins, "sha1", "left")
    other = F.col("page_id").isNull() | (F.col("origin") != F.col("page_id"))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "sha1", F.when(other, F.col("origin")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record for every row of ``pages`` (page_id, url, html); returns the manifest (path, records).

    A task writes archives of about ``archive_bytes`` to ``folder``, a place that all
    executors reach. Names are new for each attempt and only finished tasks are in the manifest, so what
    a lost task leaves is never read. Null html is an empty payload, a null url an empty one.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _file_system(folder)
        store.create_dir(root, recursive=True)
        task, made, out, size, count = TaskContext.get(), [], None, 0, 0
        for b in batches:
            for page in zip(*[c.to_pylist() for c in b.columns]):
                if out is None:
                    path = f"{root}/pages-{task.partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, size, count = store.open_output_stream(path, compression=None), 0, 0
                    info = write_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(path)), ("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(info)
                data = page_record(*page, f"{path}:{count}")
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    out.close()
                    made.append((path, count))
                    out = None
        if out is not None:
            out.close()
            made.append((path, count))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in made], pa.string()), pa.array([n for _, n in made], pa.int64())], ["path", "records"]
        )

    return write_once("warc_manifest", with_origin(pages, min_bytes).mapInArrow(write, "path string, records long"))


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Page records of the archives of ``manifest``, read one after the other from the stream.

    Returns page_id, url, payload_bytes, payload_digest, record_type, refers_to and payload (null for revisits).
    A broken archive, a wrong digest or a missing record is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _file_system(folder)[0]
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for b in batches:
            for path, records in zip(b.column("path").to_pylist(), b.column("records").to_pylist()):
                rows, held, count = [], 0, 0
                with store.open_input_stream(path, compression=None) as stream:
                    for r in read_records(stream):
                        if r.kind not in ("response", "revisit"):
                            continue
                        http, payload = r.http()
                        page, origin = r.headers.get("x-page-id"), r.headers.get("x-refers-to-page")
                        rows.append((
                            int(page) if page else None, r.headers.get("warc-target-uri"), int(http["content-length"]),
                            r.headers["warc-payload-digest"].removeprefix("sha1:"), r.kind, int(origin) if origin else None,
                            payload if r.kind == "response" else None,
                        ))
                        held, count = held + len(payload), count + 1
                        if held > 8 << 20 or len(rows) >= 5000:
                            yield _batch(rows, names, kinds)
                            rows, held = [], 0
                if count != records:
                    raise WarcError(f"{path} holds {count} of {records} records")
                if rows:
                    yield _batch(rows, names, kinds)

    # an archive is a unit of work: as many tasks as archives, for the few bytes of a manifest would be put into one
    spread = manifest.repartition(max(1, manifest.count()), "path")
    return spread.mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    )


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path there; a scheme that Arrow does not read is refused."""
    if folder.startswith("/"):
        return fs.LocalFileSystem(), folder
    scheme, _, rest = folder.partition(":")
    try:
        return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
    except (pa.ArrowInvalid, NotImplementedError) as e:
        raise ValueError(f"archives cannot be kept in {folder}: {e}") from e


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def archive_and_read(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and reads them back, without the payloads."""
    folder = new_folder(spark, "warc")
    manifest = write_archives(pages, folder, min_bytes)
    return read_archives(manifest, folder).drop("payload", "url")


__all__ = ["Record", "WarcError", "archive_and_read", "read_archives", "read_records", "write_archives", "write_record"]
