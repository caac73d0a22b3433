"""WARC archives by a table of chunks.

A payload is never held whole by a task that writes or reads archives: it travels as rows
``(record, chunk number, bytes)`` of at most ``CHUNK`` bytes, in order, and digests are carried on
from chunk to chunk.

* ``payload_digests`` streams the chunks once and gives each record's length, SHA-1 and SHA-256.
* Of records with equal payloads of at least ``min_bytes`` bytes, that with the largest id is the
  response, the others revisit it and carry no payload.
* ``write_archives`` streams chunks into files of about ``FILE_BYTES``, one gzip member per record,
  below the given folder, which all executors must share. A task writes under names of its own
  attempt; the manifest, a table that Spark commits, lists the files that count. Files that a lost
  executor left behind are in no manifest.
* ``read_archives`` streams the files of a manifest back into chunk rows and checks every response's
  length and digest on the way.

Defined results: a null payload is empty. Ids may repeat or be null (null is the smallest); rows that
share the largest id of equal payloads are responses all. Ids are whole numbers, also as text; under ANSI rules any
other is an error, as it would name no record. An empty table makes no archive and gives
no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclerlake.llm.common import landed
from cyclerlake.operators.places import with_places
from cyclerlake.session import work_folder

CHUNK = 1 << 20
FILE_BYTES = 64 << 20
LEVEL = 1
# fixed values: schemes of Hadoop and of Arrow
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}
CRAWLED = "2024-01-01T00:00:00Z"
CHUNK_FIELDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, chunk int, last boolean, data binary"


def sha1_text(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunked(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows ``(..., chunk, last, data)``: the payloads cut into pieces, in order. An empty payload is one empty piece."""
    payload = F.coalesce(F.col("payload"), F.lit(b""))
    rows = pages.withColumn("payload", payload).withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.length("payload") / chunk)).cast("int"))
    rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    data = F.substring("payload", F.col("chunk") * chunk + 1, F.lit(chunk))
    return rows.withColumn("data", data).withColumn("last", F.col("chunk") == F.col("chunks") - 1).drop("payload", "chunks")


def payload_digests(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``page_id, mark, bytes, sha1, sha256`` of every record of ``page_id, mark, payload``."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a record's chunks may continue in the next batch
        size, sha1, sha256 = 0, hashlib.sha1(), hashlib.sha256()
        for batch in batches:
            rows: list[dict] = []
            for page_id, mark, last, data in zip(*(batch.column(c).to_pylist() for c in ("page_id", "mark", "last")), batch.column("data")):
                part = data.as_buffer()
                size += part.size
                sha1.update(part)
                sha256.update(part)
                if last:
                    rows.append({"page_id": page_id, "mark": mark, "bytes": size, "sha1": sha1_text(sha1.digest()), "sha256": sha256.digest()})
                    size, sha1, sha256 = 0, hashlib.sha1(), hashlib.sha256()
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("page_id", pa.int64()), ("mark", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string()), ("sha256", pa.binary())])
    chunks = chunked(pages.select("page_id", "mark", "payload"), chunk).select("page_id", "mark", "last", "data")
    return chunks.mapInArrow(digested, "page_id long, mark long, bytes long, sha1 string, sha256 binary")


def decide(digests: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, mark, bytes, sha1, refers_to``, once per id and mark. refers_to is null for responses."""
    best = digests.groupBy(F.col("sha256").alias("s"), F.col("bytes").alias("b")).agg(F.max("page_id").alias("best"))
    joined = digests.join(best, (F.col("sha256") == F.col("s")) & (F.col("bytes") == F.col("b")))
    other = (F.col("bytes") >= min_bytes) & F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best"))
    return joined.select("page_id", "mark", "bytes", "sha1", F.when(other, F.col("best")).alias("refers_to")).distinct()


# -- records ------------------------------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def head(row: dict) -> bytes:
    """The header block; ``Payload-Length`` is an extension that tells a revisit's full length."""
    revisit = row["refers_to"] is not None
    url = (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(row["page_id"])),
        ("WARC-Target-URI", url),
        ("WARC-Date", CRAWLED),
        ("WARC-Payload-Digest", f"sha1:{row['sha1']}"),
        ("Payload-Length", row["bytes"]),
    ]
    if revisit:
        fields += [("WARC-Refers-To", record_id(row["refers_to"])), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "text/html"), ("Content-Length", 0 if revisit else row["bytes"])]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def parse_head(lines: list[bytes]) -> dict:
    fields = dict(line.decode().split(": ", 1) for line in lines[1:] if b": " in line)

    def page(name: str) -> int | None:
        found = fields.get(name, "<urn:page:>")[10:-1]
        return int(found) if found else None

    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI", ""),
        "record_type": fields["WARC-Type"],
        "refers_to": page("WARC-Refers-To"),
        "payload_bytes": int(fields["Payload-Length"]),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "length": int(fields["Content-Length"]),
    }


def as_arrow(folder: str) -> str:
    """The folder under the name that Arrow has for its file system, where Hadoop has another."""
    scheme, mark, rest = folder.partition("://")
    return f"{ARROW_SCHEMES.get(scheme.lower(), scheme)}{mark}{rest}"


class Writer:
    """Files of about ``file_bytes`` with one gzip member per record."""

    def __init__(self, folder: str, file_bytes: int):
        self.files, self.base = fs.FileSystem.from_uri(as_arrow(folder))
        self.files.create_dir(self.base, recursive=True)
        context = TaskContext.get()
        self.name = f"{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        self.file_bytes, self.n, self.out, self.done = file_bytes, 0, None, []

    def begin(self, first: bytes) -> None:
        if self.out is None:
            self.path = f"{self.base}/{self.name}-{self.n:05d}.warc.gz"
            self.out, self.n, self.records, self.size = self.files.open_output_stream(self.path, compression=None), self.n + 1, 0, 0
        self.zip = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        self.put(first)

    def put(self, data: bytes) -> None:
        part = self.zip.compress(data)
        self.out.write(part)
        self.size += len(part)

    def end(self) -> None:
        self.put(b"\r\n\r\n")
        part = self.zip.flush()
        self.out.write(part)
        self.size += len(part)
        self.records += 1
        if self.size >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append({"path": self.path, "records": self.records, "bytes": self.size})
            self.out = None


def write_archives(pages: DataFrame, decisions: DataFrame, folder: str, chunk: int = CHUNK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``page_id, mark, url, payload`` and returns the manifest: path, records, bytes of every archive."""
    told = decisions.select(F.col("page_id").alias("p"), F.col("mark").alias("m"), "bytes", "sha1", "refers_to")
    rows = pages.join(told, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("mark") == F.col("m")))
    rows = rows.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))
    rows = rows.select("page_id", "url", "bytes", "sha1", "refers_to", "payload")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Writer(folder, file_bytes)
        for batch in batches:
            names = ["page_id", "url", "bytes", "sha1", "refers_to", "chunk", "last"]
            for values in zip(*(batch.column(c).to_pylist() for c in names), batch.column("data")):
                row = dict(zip(names, values))
                if row["chunk"] == 0:
                    out.begin(head(row))
                out.put(values[-1].as_buffer())
                if row["last"]:
                    out.end()
        out.close()
        yield pa.RecordBatch.from_pylist(out.done, pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return landed(chunked(rows, chunk).mapInArrow(written, "path string, records long, bytes long"), "warc-manifest")


class Reader:
    """Decompressed bytes of a file of gzip members, with look-ahead for lines."""

    def __init__(self, source: BinaryIO, chunk: int):
        self.source, self.chunk, self.zip, self.data = source, chunk, None, bytearray()
        self.raw = b""

    def more(self) -> bool:
        if not self.raw:
            self.raw = self.source.read(min(self.chunk, 1 << 18))
            if not self.raw:
                return False
        if self.zip is None:
            self.zip = zlib.decompressobj(31)
        self.data += self.zip.decompress(self.raw, self.chunk)
        self.raw = self.zip.unconsumed_tail
        if self.zip.eof:
            self.raw, self.zip = self.zip.unused_data, None
        return True

    def head(self) -> list[bytes] | None:
        while (end := self.data.find(b"\r\n\r\n")) < 0:
            if not self.more():
                return None
        lines = bytes(self.data[:end]).split(b"\r\n")
        del self.data[: end + 4]
        return lines

    def take(self, size: int) -> bytes:
        while len(self.data) < size and self.more():
            pass
        if len(self.data) < size:
            raise ValueError("archive ends inside a record")
        part = bytes(self.data[:size])
        del self.data[:size]
        return part


def records(source: BinaryIO, chunk: int, with_data: bool) -> Iterator[dict]:
    """Chunk rows of one archive; without data one row per record. Responses are checked."""
    reader = Reader(source, chunk)
    while (lines := reader.head()) is not None:
        told = parse_head(lines)
        left, number, sha1 = told.pop("length"), 0, hashlib.sha1()
        while True:
            data = reader.take(min(chunk, left))
            left -= len(data)
            sha1.update(data)
            if with_data or not left:
                yield {**told, "chunk": number, "last": not left, "data": data if with_data else None}
            number += 1
            if not left:
                break
        if told["record_type"] == "response" and sha1_text(sha1.digest()) != told["payload_digest"]:
            raise ValueError(f"damaged payload of page {told['page_id']}")
        reader.take(4)


def read_archives(manifest: DataFrame, scheme: str, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """Chunk rows of all archives of a manifest, one task or more per archive."""
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64())]
        + [("payload_digest", pa.string()), ("chunk", pa.int32()), ("last", pa.bool_()), ("data", pa.binary())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(as_arrow(scheme))
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with files.open_input_stream(path, compression=None) as source:
                    rows, size = [], 0
                    for row in records(source, chunk, with_data):
                        rows.append(row)
                        size += len(row["data"] or b"")
                        if size >= 8 * chunk or len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    # the manifest is small, the archives are not: adaptive execution must not merge these partitions
    spread = with_places(manifest.select("path")).repartitionById(max(1, manifest.count()), F.col("place").cast("int"))
    return spread.mapInArrow(read, CHUNK_FIELDS)


def archive(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", page: str = "html", min_bytes: int = 0, chunk: int = CHUNK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes all pages below ``folder`` and returns the manifest."""
    payload = F.coalesce(F.col(page).cast("string"), F.lit("")).cast("binary")
    # the mark tells different rows under one id apart
    mark = F.xxhash64(F.col(page).cast("string"), F.col(url))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), mark.alias("mark"), F.col(url).alias("url"), payload.alias("payload"))
    decisions = landed(decide(landed(payload_digests(rows, chunk), "warc-digests"), min_bytes), "warc-decisions")
    return write_archives(rows, decisions, folder, chunk, file_bytes)


def round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` as the archives have them."""
    folder = folder or work_folder(pages.sparkSession, "warc-archives")
    read = read_archives(archive(pages, folder, **options), folder, with_data=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
