"""WARC archives of web pages: a writer with revisit records and a splittable reader.

Every record is one gzip member, so an archive can be read from any member on. A read task gets a
byte range. It scans the range for the gzip magic number, and for each candidate decodes the
member's head: a candidate counts if that decodes to a WARC version line and complete headers and
if the member ends at another member or at the end of the file. A task owns the records that
*start* in its range and reads on behind the range to finish the last one; a record that started
earlier belongs to the task before. Files are opened through the file system of their URI, so a
range is read wherever the archives are.

Writing: payloads are grouped by digest and length; of a group with payloads of at least
``min_bytes`` bytes, the row with the largest id is the response, the others are revisit records
that refer to it and hold the HTTP head alone. Each task writes its archive under a temporary name
and renames it when it is whole, so retries and lost executors leave no partial archive behind.

Defined results: a null html is an empty payload; a null url leaves out the target header; a null
id is smaller than any other; rows that tie on the id are told apart by their place in the input;
an empty table gives no record. Columns other than id, url and html are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import ROW, materialise, stable, with_row_id
from newsloom.session import scratch_path

#: Fixed values of the formats.
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 20
FIRST_BYTES = 512  # decoded at a candidate before its version line is checked
COMPRESSION = 4


def open_uri(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(quote(uri, safe=":/%=,@+~") if "://" in uri else uri.removeprefix("file:"))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, row) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{row}>"


def encode_record(kind: str, own: str, refers_to: str | None, url: str | None, digest: str, payload: bytes,
                  length: int) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP head, whose length is the payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    member = zlib.compressobj(COMPRESSION, zlib.DEFLATED, 31)
    return member.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + member.flush()


def plan_records(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """The rows to write: payload, digest, and for revisits the id and row of their response."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = with_row_id(stable(pages), F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                       payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("length", F.octet_length("payload").cast("long"))
    copies = rows.filter(F.col("length") >= min_bytes).groupBy("digest", "length").agg(
        F.max(F.struct("id", ROW)).alias("first"), F.count("*").alias("n")).filter("n > 1")
    copies = materialise(copies.select("digest", "length", F.col("first.id").alias("first_id"),
                                       F.col(f"first.{ROW}").alias("first_row")), "warc-copies")
    return rows.join(copies, ["digest", "length"], "left").withColumn(
        "revisit", F.coalesce(F.col("first_row") != F.col(ROW), F.lit(False)))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write all rows as WARC archives under the folder ``path``; returns ``path, records, bytes``."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_uri(path)
        store.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        temporary = f"{folder}/_{name}.{uuid.uuid4().hex}"
        count = size = 0
        out = None
        for batch in batches:
            columns = [batch.column(c) for c in ("id", ROW, "url", "digest", "length", "revisit", "first_id", "first_row")]
            payloads = batch.column("payload")
            for at, (page, row, url, sha, length, revisit, first, first_row) in enumerate(
                    zip(*(c.to_pylist() for c in columns))):
                out = out or store.open_output_stream(temporary)
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                payload = b"" if revisit else payloads[at].as_py()
                data = encode_record("revisit" if revisit else "response", record_id(page, row),
                                     record_id(first, first_row) if revisit else None, url, digest, payload, length)
                out.write(data)
                count, size = count + 1, size + len(data)
        if out:
            out.close()
            store.move(temporary, f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([f"{path}/{name}"]), pa.array([count]), pa.array([size])],
                                             names=["path", "records", "bytes"])

    planned = plan_records(pages, id_col, url_col, html_col, min_bytes)
    return materialise(planned.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


class RangeReader:
    """Members of one file that start in [start, end).

    The file is read once, front to back, in blocks of ``read_bytes``; what lies behind the place that is
    looked at is let go. Only a candidate that turns out to be no record after more than its version line
    was seen makes the reader go back. Behind a record the next one is taken at once if it starts there.
    """

    def __init__(self, handle, size: int, start: int, end: int, read_bytes: int = READ_BYTES):
        self.handle, self.size, self.start, self.end, self.read_bytes = handle, size, start, min(end, size), read_bytes
        self.buffer, self.base, self.bytes_read = bytearray(), start, 0

    def _fill(self, end: int) -> None:
        """Have the bytes up to ``end`` (or the file's end) in the buffer."""
        while self.base + len(self.buffer) < min(end, self.size):
            at = self.base + len(self.buffer)
            self.handle.seek(at)
            data = self.handle.read(min(self.read_bytes, self.size - at))
            if not data:
                raise OSError(f"file ends at {at}, not at {self.size}")
            self.bytes_read += len(data)
            self.buffer += data

    def _let_go(self, at: int) -> None:
        """The bytes before ``at`` are not needed any more; go back if ``at`` was let go already."""
        if at < self.base or at > self.base + len(self.buffer):
            self.buffer, self.base = bytearray(), at
        else:
            del self.buffer[: at - self.base]
            self.base = at

    def _peek(self, at: int, n: int) -> bytes:
        self._fill(at + n)
        return bytes(self.buffer[at - self.base: at - self.base + n])

    def member(self, at: int) -> tuple[bytes, int] | None:
        """Content and end of the member at ``at``, or None if no record starts there."""
        unpack, parts, checked = zlib.decompressobj(31), [], False
        position = at
        while not unpack.eof:
            data = self._peek(position, FIRST_BYTES) if not checked else self._peek(position, max(
                1, min(self.read_bytes, self.base + len(self.buffer) - position)))
            if not data:
                return None
            try:
                parts.append(unpack.decompress(data))
            except zlib.error:
                return None
            position += len(data)
            if not checked:  # other members are left at once
                parts = [b"".join(parts)]
                if not VERSION.startswith(parts[0][:len(VERSION)]):
                    return None
                checked = len(parts[0]) >= len(VERSION)
            else:
                self._let_go(position)
        content = b"".join(parts)
        if not checked or b"\r\n\r\n" not in content:  # headers may have any length
            return None
        end = position - len(unpack.unused_data)
        if end < self.base:  # the rest of the last block was let go
            self.buffer[:0] = unpack.unused_data
            self.base = end
        if end < self.size and self._peek(end, len(GZIP_MAGIC)) != GZIP_MAGIC[: self.size - end]:
            return None
        return content, end

    def __iter__(self) -> Iterator[bytes]:
        at = self.start
        while at < self.end:
            self._let_go(at)
            self._fill(at + len(GZIP_MAGIC))
            found = self.buffer.find(GZIP_MAGIC)
            if found < 0:  # the magic number may begin in the last bytes
                at += max(1, len(self.buffer) - len(GZIP_MAGIC) + 1)
                continue
            if at + found >= self.end:
                return
            record = self.member(at + found)
            if record is None:
                at += found + 1
            else:
                yield record[0]
                at = record[1]


def parse_record(content: bytes) -> dict:
    """Headers and payload of a record; the payload follows the HTTP head."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[: int(fields.get("content-length", len(rest)))]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = len(payload)
    for line in http.decode("latin-1").split("\r\n"):
        if line.lower().startswith("content-length:"):
            length = int(line.partition(":")[2])
    declared = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    kind = fields.get("warc-type")
    return {"record_type": kind, "record_id": fields.get("warc-record-id"), "refers_to": fields.get("warc-refers-to"),
            "uri": fields.get("warc-target-uri"), "payload_digest": declared, "payload_bytes": length,
            "payload": payload if kind != "revisit" else None,
            "intact": kind == "revisit" or declared in (None, base32_sha1(payload))}


RECORD_SCHEMA = ("record_type string, record_id string, refers_to string, uri string, payload_digest string, "
                 "payload_bytes long, payload binary, intact boolean")
_ARROW_SCHEMA = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
                           ("uri", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                           ("payload", pa.binary()), ("intact", pa.bool_())])


def read_archives(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records of the archives in a folder (or glob), one row each; ``intact`` tells whether a
    response's payload has the digest that its header states."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path)
             .select("path", "length").filter("length > 0"))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long")))
    ranges = files.select("path", "length", starts.alias("start"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "start"))):
                store, name = open_uri(where)
                with store.open_input_file(name) as handle:
                    held, held_bytes = [], 0
                    for content in RangeReader(handle, size, start, start + split_bytes):
                        held.append(parse_record(content))
                        held_bytes += len(content)
                        if held_bytes >= READ_BYTES:
                            yield pa.RecordBatch.from_pylist(held, schema=_ARROW_SCHEMA)
                            held, held_bytes = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema=_ARROW_SCHEMA)

    return ranges.repartition(parts, "path", "start").mapInArrow(read, RECORD_SCHEMA)


def round_trip(pages: DataFrame, min_bytes: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to fresh archives in the shared folder and read them back."""
    path = scratch_path(pages.sparkSession, "warc")
    if write_archives(pages, path, min_bytes=min_bytes).isEmpty():
        return pages.sparkSession.createDataFrame([], RECORD_SCHEMA)
    return read_archives(pages.sparkSession, path, split_bytes)
