"""WARC archives: written by tasks, read back record by record.

Each task writes its pages to archives in a shared folder, one gzip member per record, and
returns what it wrote. A file gets its name only when it is whole, so a task that runs again
replaces it. Pages with equal payloads are stored once: the one with the largest id is the
response, others are revisits that refer to it.

The reader goes through an archive in one pass: it inflates a member piece by piece, takes
the block by its content length and checks both digests. It holds one record at a time.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..storage import new_folder, qualified
from .common import if_small, write_through

ARCHIVE_BYTES = 256 << 20  # an archive is closed once it is larger
PIECE = 1 << 16  # bytes read at a time
LONGEST_HEADER = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

_UNSAFE = re.compile(r"[^\x21-\x7e]")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path and the path on it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", re.sub(r"^s3[an]:", "s3:", uri)))


def _printable(text: str) -> str:
    """Characters that a header line cannot hold, as percent escapes of their UTF-8 bytes."""
    return _UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m.group().encode("utf-8", "surrogatepass")), text)


def record(name: str, uri: str | None, payload: bytes, refers_to: str | None, date: str = DATE) -> bytes:
    """One record as one gzip member; with ``refers_to`` a revisit without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    lines += [f"WARC-Record-ID: <urn:page:{_printable(name)}>", f"WARC-Date: {date}"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_printable(uri)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{_printable(refers_to)}>"]
    lines += [
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        f"Content-Length: {len(block)}",
    ]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def members(source: BinaryIO) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as pieces of inflated bytes.

    A member must be read to its end before the next one is asked for.
    """
    held = source.read(PIECE)
    while held:
        inflate = zlib.decompressobj(31)

        def pieces(inflate=inflate):
            nonlocal held
            while not inflate.eof:
                data = inflate.decompress(inflate.unconsumed_tail or held, PIECE)
                if inflate.eof:
                    held = inflate.unused_data  # the next member begins here
                elif not inflate.unconsumed_tail:
                    held = source.read(PIECE)
                    if not held:
                        raise ValueError("the archive ends inside a record")
                if data:
                    yield data
            held = held or source.read(PIECE)

        yield pieces()


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs if k.strip()}


def read_record(pieces: Iterator[bytes]) -> dict:
    """Headers and payload of one record; raises ValueError where framing or a digest is wrong."""
    held = bytearray()
    for piece in pieces:
        held += piece
        if b"\r\n\r\n" in held or len(held) > LONGEST_HEADER:
            break
    head, mark, rest = bytes(held).partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"WARC/"):
        raise ValueError("no WARC header")
    headers = _headers(head)
    length = int(headers["content-length"])
    body = bytearray(rest)
    for piece in pieces:
        body += piece
        if len(body) > length + 4:
            break
    if len(body) != length + 4 or body[length:] != b"\r\n\r\n":
        raise ValueError(f"{headers.get('warc-record-id')}: content length {length} does not frame the block")
    block = bytes(body[:length])
    if headers.get("warc-block-digest", f"sha1:{sha1_base32(block)}") != f"sha1:{sha1_base32(block)}":
        raise ValueError(f"{headers.get('warc-record-id')}: wrong block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    inner = _headers(http)
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    revisit = headers["warc-type"] == "revisit"
    if not revisit and digest != sha1_base32(payload):
        raise ValueError(f"{headers.get('warc-record-id')}: wrong payload digest")
    name = lambda key: headers[key].removeprefix("<urn:page:").removesuffix(">") if key in headers else None
    return {
        "record_type": headers["warc-type"],
        "name": name("warc-record-id"),
        "uri": headers.get("warc-target-uri"),
        "refers_to": name("warc-refers-to"),
        "payload_bytes": int(inner["content-length"]) if revisit else len(payload),
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    uri_col: str = "url",
    body_col: str = "html",
    min_bytes: int = 0,
) -> DataFrame:
    """Write a record per row of ``pages`` and return the archives: ``archive`` (path), ``records``, ``bytes``.

    ``folder`` is any place that all executors reach and pyarrow can open, as Spark reads
    the path (without a scheme it is on the default file system); by default a new one below
    the shared folder. A task that runs again replaces its archives. Payloads of at least ``min_bytes`` that occur more than
    once are stored with the largest id (rows that repeat it are all responses); a null id
    is smaller than all others. A null body is an empty payload, a null address gives no
    address line. An empty table gives no archives; other columns are not read.
    """
    spark = pages.sparkSession
    folder = qualified(spark, folder or new_folder(spark, "warc"))  # tasks must not take it for their own disk
    bare = _open_folder(folder)[1]  # raises here if pyarrow has no such file system
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(uri_col).cast("string").alias("uri"),
        F.encode(F.coalesce(F.col(body_col).cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("sha1", F.when(F.octet_length("payload") >= min_bytes, F.sha1("payload")))
    repeated = (
        rows.filter(F.col("sha1").isNotNull())
        .groupBy("sha1")
        .agg(F.max("id").alias("last"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("sha1", "last")
    )
    marked = rows.join(if_small(write_through(repeated, "warc-repeated")), "sha1", "left").select(
        F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("name"),
        "uri",
        "payload",
        F.when(F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last")), F.col("last").cast("string")).alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, path = _open_folder(folder)
        store.create_dir(path, recursive=True)
        done, number, out, temporary, records, size = [], 0, None, "", 0, 0

        def close():
            nonlocal out, number
            out.close()
            final = f"{path}/part-{context.partitionId():05d}-{number:04d}.warc.gz"
            if store.get_file_info(final).type != fs.FileType.NotFound:  # of a run that was lost afterwards
                store.delete_file(final)
            store.move(temporary, final)
            done.append((final, records, size))
            out, number = None, number + 1

        for batch in batches:
            for name, uri, payload, refers_to in zip(*batch.columns, strict=True):
                if out is None:
                    temporary = f"{path}/_writing-{context.partitionId():05d}-{number:04d}-{context.taskAttemptId()}"
                    out, records, size = store.open_output_stream(temporary, compression=None), 0, 0
                data = record(name.as_py(), uri.as_py(), payload.as_py(), refers_to.as_py())
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    close()
        if out is not None:
            close()
        if done:
            columns = [pa.array(c) for c in zip(*done, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["archive", "records", "bytes"])

    written = write_through(marked.mapInArrow(write, "archive string, records bigint, bytes bigint"), "warc-archives")
    # pyarrow names files without scheme and host; put them back
    return written.withColumn("archive", F.concat(F.lit(folder), F.substring("archive", len(bare) + 1, 1 << 20)))


def read_archives(archives: DataFrame, id_type: str = "bigint") -> DataFrame:
    """All records of the archives (column ``archive``), one task per archive at a time.

    ``record_type``, ``page_id``, ``uri``, ``refers_to``, ``payload_bytes``, ``payload_digest`` and
    ``payload`` (null for revisits). A damaged archive raises.
    """
    schema = (
        "record_type string, name string, uri string, refers_to string, payload_bytes bigint, "
        "payload_digest string, payload binary"
    )
    fields = [f.split()[0] for f in schema.split(", ")]
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    target = pa.schema([(f, kinds.get(f, pa.string())) for f in fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                store, path = _open_folder(archive.as_py())
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for pieces in members(source):
                        rows.append(read_record(pieces))
                        for _ in pieces:
                            raise ValueError("a member holds more than one record")
                        held += len(rows[-1]["payload"] or b"")
                        if len(rows) >= 1000 or held >= 1 << 23:
                            yield pa.RecordBatch.from_pylist(rows, schema=target)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=target)

    spread = archives.select("archive").repartition(max(1, archives.count()))
    number = lambda c: F.when(F.col(c) != "null", F.col(c)).cast(id_type)
    return (
        spread.mapInArrow(read, schema)
        .withColumns({"page_id": number("name"), "refers_to": number("refers_to")})
        .drop("name")
    )
