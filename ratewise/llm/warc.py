"""WARC archives: writing, normalising monolithic gzip files, reading by offset index.

* :func:`write_archives` writes a record per page. Of pages with equal payloads
  the one with the smallest id is a response, the others revisit it. Each task
  writes whole files as one gzip stream (the form that cannot be read at
  random).
* :func:`normalise` inflates such a stream once, front to back, and rewrites
  every record as a gzip member of its own, with a sidecar index of offsets.
* :func:`read_archives` opens each record at its offset.

Files go to the shared folder through its own file system (local, HDFS or an
object store: whatever pyarrow opens by URI). A file counts only if the table
that lists it does, so files of lost or repeated task attempts are ignored.
A task holds one record at a time beside its buffers.

Null payloads count as empty. Pages with a null id never are the smallest;
if they have an equal with an id they revisit it. Rows with equal ids and
equal payloads are all responses if theirs is the smallest id. Null addresses
are left out of the record. An empty table gives no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm.common import steps, stored
from ratewise.session import scratch_path

#: Payload bytes after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
READ_BYTES, GZIP_LEVEL, GZIP = 1 << 20, 1, 31
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def _open(uri: str):
    """(file system, path) of a URI or plain path."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP head, with the full payload's length, and drops the payload."""
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base32(sha1_hex)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    block: bytes

    def page(self, name: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", self.headers.get(name, ""))
        return int(found[1]) if found else None


def _head(data: bytes) -> dict[str, str]:
    first, *lines = data.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no record begins here: {first[:60]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def inflate(source) -> Iterator[bytes]:
    """A gzip stream's bytes, piece by piece, whatever its number of members."""
    unzip = zlib.decompressobj(GZIP)
    while data := source.read(READ_BYTES):
        while data:
            if unzip.eof:
                unzip = zlib.decompressobj(GZIP)
            piece = unzip.decompress(data, 4 * READ_BYTES)
            data = unzip.unused_data if unzip.eof else unzip.unconsumed_tail
            if piece:
                yield piece
    if not unzip.eof:
        tail = unzip.flush()
        if tail:
            yield tail
        if not unzip.eof:
            raise ValueError("the gzip stream ends too early")


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, as bytes, of an inflated archive; holds one record and a piece."""
    held, need = bytearray(), None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(_head(bytes(held[:end]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the archive ends inside a record")


def parse(data: bytes) -> Record:
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = _head(head)
    return Record(headers, rest[:int(headers["content-length"])])


def _typed(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to): refers_to is null for responses."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    firsts = (rows.where(F.octet_length("payload") >= least_bytes).groupBy("sha1")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    joined = rows.join(firsts, "sha1", "left")
    other = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "payload", "sha1", F.when(other, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write monolithic archives below ``folder``; their stored list (archive, records)."""
    def run(batches):
        from pyspark import TaskContext

        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        context, made = TaskContext.get(), 0
        out = zipper = None
        rows = (row for b in steps(batches, "payload") for row in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))))
        for row in rows:
            if out is None:
                name = f"{context.partitionId():06d}-{made:04d}-{uuid.uuid4().hex[:12]}.warc.gz"
                out, zipper = fs.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(GZIP_LEVEL, wbits=GZIP)
                made, size, count = made + 1, 0, 0
            out.write(zipper.compress(record(*row)))
            size, count = size + len(row[2]), count + 1
            if size >= archive_bytes:
                out.write(zipper.flush())
                out.close()
                out = None
                yield pa.RecordBatch.from_pydict({"archive": [name], "records": [count]})
        if out is not None:
            out.write(zipper.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [name], "records": [count]})

    return stored(_typed(pages, least_bytes).mapInArrow(run, "archive string, records long"), "archives")


def _spread(archives: DataFrame) -> DataFrame:
    """A task for each archive, up to a few thousand at a time."""
    n = archives.count()
    return archives.select("archive").repartition(max(1, min(n, 4096)))


def normalise(archives: DataFrame, folder: str, target: str) -> DataFrame:
    """Rewrite listed archives below ``target`` with a member per record; stored list (archive, records).

    Beside each archive ``<name>.idx`` has a line per record: offset, length of the member, record id.
    """
    def run(batches):
        source_fs, source = _open(folder)
        fs, base = _open(target)
        fs.create_dir(base, recursive=True)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                mine = f"{name.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:12]}.warc.gz"
                lines, at = [], 0
                with source_fs.open_input_stream(f"{source}/{name}", compression=None) as f, fs.open_output_stream(f"{base}/{mine}", compression=None) as out:
                    for data in split_records(inflate(f)):
                        member = zlib.compress(data, GZIP_LEVEL, wbits=GZIP)
                        out.write(member)
                        lines.append(f"{at}\t{len(member)}\t{_head(data[:data.find(b'\r\n\r\n')])['warc-record-id']}\n")
                        at += len(member)
                with fs.open_output_stream(f"{base}/{mine}.idx", compression=None) as out:
                    out.write("".join(lines).encode())
                yield pa.RecordBatch.from_pydict({"archive": [mine], "records": [len(lines)]})

    return stored(_spread(archives).mapInArrow(run, "archive string, records long"), "normalised")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """A row per record, each opened at its offset: page_id, url, record_type, refers_to, payload (null for revisits), payload_bytes, payload_digest.

    A response whose payload does not fit its digest is an error.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def row(data: bytes) -> dict:
        found = parse(data)
        head, _, payload = found.block.partition(b"\r\n\r\n")
        kind, digest = found.headers["warc-type"], found.headers["warc-payload-digest"].removeprefix("sha1:")
        size = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        if kind == "response" and (size != len(payload) or base32(hashlib.sha1(payload).hexdigest()) != digest):
            raise ValueError(f"the payload of {found.headers['warc-record-id']} does not fit its digest")
        return {"page_id": found.page("warc-record-id"), "url": found.headers.get("warc-target-uri"), "record_type": kind,
                "refers_to": found.page("warc-refers-to"), "payload": payload if kind == "response" else None,
                "payload_bytes": size, "payload_digest": digest}

    def run(batches):
        fs, base = _open(folder)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                with fs.open_input_stream(f"{base}/{name}.idx", compression=None) as f:
                    index = [line.split("\t") for line in f.read().decode().splitlines()]
                with fs.open_input_file(f"{base}/{name}") as f:
                    held, size = [], 0
                    for offset, length, _ in index:
                        f.seek(int(offset))
                        held.append(row(zlib.decompress(f.read(int(length)), wbits=GZIP)))
                        size += held[-1]["payload_bytes"]
                        if size > READ_BYTES:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)

    return _spread(archives).mapInArrow(
        run, "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string")


def round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write, normalise and read back ``pages`` in fresh folders below the shared one."""
    raw, normal = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc-normal")
    written = write_archives(pages, raw, least_bytes)
    return read_archives(normalise(written, raw, normal), normal)
