"""WARC archives with payloads handled as chunk rows.

Writing: a page becomes rows of (record, chunk number, data); a task streams them into gzip members
of archive files and hashes as it goes, so Python never holds a payload. Reading: a task streams an
archive and gives the same kind of rows, each with the number of bytes so far and the SHA-1 of the
payload up to its end, so the last row of a record carries the digest of all of it.

Of records with equal payloads of at least ``min_bytes``, that of the largest page id is the
response and the others are revisits that refer to it. Only digest, length and id are aggregated
and joined for that (salted, a payload may fill a third of all pages).

Archive files lie in a new folder below the shared folder. A task writes files of its own name and
lists them in its output, which is stored once: files of lost or repeated attempts are in no list.
They are opened through pyarrow, which knows file, HDFS and object store addresses.

Edge cases: null html is the empty payload; rows of one id and payload are all responses (or all
revisits); a row without an id is a revisit of its payload's largest id, or a response if the
payload has none; line breaks in an address are escaped, a null address is left out; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import batchwise
from pressloom.operators.joins import lookup
from pressloom.session import materialize, shared_dir

CHUNK = 1 << 20
ROLL = 256 << 20
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of their own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_ROWS = ("path string, record int, record_type string, record_id string, refers_to string, payload_bytes bigint, "
                "chunk_no int, last boolean, bytes_so_far bigint, sha1_so_far string, data binary")


def chunk_rows(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Chunk rows of all pages, those of a record together and in order; a revisit has one without data."""
    payload = F.coalesce(F.col(body).cast("string"), F.lit("")).cast("binary")
    facts = pages.select(F.col(key).alias("_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    digest = facts.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "sha1": F.sha1("payload")})
    keyed = digest.withColumn("_same", F.concat_ws(":", "sha1", "payload_bytes"))
    groups = keyed.where(F.col("payload_bytes") >= min_bytes).groupBy("_same").agg(F.max("_id").alias("_first"), F.count("*").alias("_n"))
    shared = materialize(groups.where("_n > 1 AND _first IS NOT NULL").drop("_n"), "equal-payloads")
    marked = lookup(keyed, shared, "_same", ["_id"])
    revisit = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    refers = F.when(revisit, F.col("_first").cast("string"))
    chunks = F.when(revisit, F.lit(1)).otherwise(F.greatest(F.ceil(F.col("payload_bytes") / chunk), F.lit(1))).cast("int")
    rows = marked.select(F.col("_id").cast("string").alias("page"), "url", "payload_bytes", "sha1", refers.alias("refers_to"), chunks.alias("chunks"), "payload")
    split = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk_no"))
    data = F.when(F.col("refers_to").isNull(), F.substring("payload", F.col("chunk_no") * F.lit(chunk) + 1, F.lit(chunk)))
    return split.select("page", "url", "payload_bytes", "sha1", "refers_to", "chunk_no", "chunks", data.alias("data"))


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _record_id(page: str | None) -> str:
    return f"<urn:page:{page}>" if page is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _safe(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def _header(row: dict) -> bytes:
    """WARC header, and for a response the HTTP header that stands before the payload."""
    revisit, inner = row["refers_to"] is not None, b""
    if not revisit:
        inner = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(row['page'])}", f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_safe(row['url'])}"] if row["url"] is not None else []),
        f"WARC-Payload-Digest: sha1:{base32_sha1(row['sha1'])}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(row['refers_to'])}"] if revisit else []),
        f"X-Payload-Length: {row['payload_bytes']}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {0 if revisit else len(inner) + row['payload_bytes']}",
    ]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + inner


class ArchiveWriter:
    """Streams records, one gzip member each, into files of about ``roll`` bytes."""

    def __init__(self, folder: str, roll: int):
        self.files, self.path = pafs.FileSystem.from_uri(folder)
        self.folder = folder
        self.roll, self.out, self.done = roll, None, []

    def begin(self) -> None:
        if self.out is None:
            self.name, self.records, self.size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
            self.out = self.files.open_output_stream(f"{self.path}/{self.name}", compression=None)
        self.member = zlib.compressobj(1, zlib.DEFLATED, 31)

    def write(self, data: bytes) -> None:
        self._put(self.member.compress(data))

    def end(self) -> None:
        self._put(self.member.flush())
        self.records += 1
        if self.size >= self.roll:
            self.close()

    def _put(self, packed: bytes) -> None:
        self.out.write(packed)
        self.size += len(packed)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.folder}/{self.name}", self.records, self.size))
            self.out = None


def write_archives(chunks: DataFrame, folder: str, roll: int = ROLL) -> DataFrame:
    """Write the records; the stored list of (path, records, bytes) names the valid files."""
    files, path = pafs.FileSystem.from_uri(folder)
    files.create_dir(path)

    def run(batches):
        writer = ArchiveWriter(folder, roll)
        expected, digest = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk_no"] != expected:
                    raise ValueError(f"chunk {row['chunk_no']} of page {row['page']} came where {expected} was due")
                if expected == 0:
                    writer.begin()
                    writer.write(_header(row))
                    digest = hashlib.sha1()
                expected += 1
                if row["data"] is not None:
                    digest.update(row["data"])
                    writer.write(row["data"])
                if expected == row["chunks"]:
                    if row["refers_to"] is None and digest.hexdigest() != row["sha1"]:
                        raise ValueError(f"page {row['page']}: the chunks do not make up the payload")
                    writer.write(b"\r\n\r\n")
                    writer.end()
                    expected = 0
        writer.close()
        listed = list(zip(*writer.done)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(listed[0], pa.string()), pa.array(listed[1], pa.int64()), pa.array(listed[2], pa.int64())], ["path", "records", "bytes"])

    return materialize(batchwise(chunks, run, "path string, records bigint, bytes bigint"), "archives")


@dataclass
class Chunk:
    header: dict[str, str]
    record: int
    chunk_no: int
    last: bool
    size: int       # payload bytes so far
    digest: str     # of the payload so far
    data: bytes


def _fields(stream) -> dict[str, str]:
    """Header lines up to the empty one; the number of bytes read is under ''."""
    out, size = {}, 0
    while True:
        line = stream.readline()
        size += len(line)
        if line in (b"\r\n", b"\n", b""):
            return out | {"": str(size)}
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()


def read_records(stream, chunk: int = CHUNK) -> Iterator[Chunk]:
    """Chunks of all records of an uncompressed WARC stream."""
    record = 0
    while version := stream.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {version[:40]!r}")
        header = _fields(stream)
        left = int(header["content-length"])
        if header.get("warc-type") == "response" and header.get("content-type", "").startswith("application/http") and left:
            status = stream.readline()
            left -= len(status) + int(_fields(stream)[""])
        digest, size, number = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(chunk, left))
            if not data and left:
                raise ValueError(f"record {record} ends {left} bytes early")
            left -= len(data)
            size += len(data)
            digest.update(data)
            yield Chunk(header, record, number, not left, size, digest.hexdigest(), data)
            number += 1
            if not left:
                break
        record += 1


def read_archives(archives: DataFrame, with_data: bool = True, chunk: int = CHUNK, batch_bytes: int = 8 << 20) -> DataFrame:
    """Chunk rows of the listed archives; a task streams one file after the other."""

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = pafs.FileSystem.from_uri(path)
                with files.open_input_stream(name, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for c in read_records(stream, chunk):
                        check(path, c)
                        h = c.header
                        rows.append((path, c.record, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-refers-to"),
                                     int(h.get("x-payload-length", c.size)), c.chunk_no, c.last, c.size,
                                     c.digest if h.get("warc-type") != "revisit" else declared(h), c.data if with_data else None))
                        size += len(c.data) if with_data else 0
                        if size >= batch_bytes or len(rows) >= 10_000:
                            yield packed(rows)
                            rows, size = [], 0
        yield packed(rows)

    def declared(header: dict[str, str]) -> str:
        return base64.b32decode(header["warc-payload-digest"].removeprefix("sha1:")).hex()

    def check(path: str, c: Chunk) -> None:
        if c.last and c.header.get("warc-type") == "response" and "warc-payload-digest" in c.header and declared(c.header) != c.digest:
            raise ValueError(f"{path}, record {c.record}: the payload does not have the digest of its header")

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * 11
        kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
        names = [f.split()[0] for f in ARCHIVE_ROWS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return batchwise(archives.select("path"), run, ARCHIVE_ROWS)


def archive_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, as a full address."""
    shared_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/warc-{uuid.uuid4().hex}"


def round_trip(pages: DataFrame, key: str = "page_id", folder: str | None = None, **options) -> DataFrame:
    """Write all pages, read the archives back; per record: page id, payload and what it refers to."""
    archives = write_archives(chunk_rows(pages, key, **options), folder or archive_folder(pages.sparkSession))
    # One file per task: their sizes are bounded by the writer.
    spread = archives.repartition(max(1, archives.count()))
    last = read_archives(spread, with_data=False).where("last")
    kind = pages.select(key).dtypes[0][1]

    def page(column: str) -> Column:
        return F.regexp_extract(column, "^<urn:page:(.*)>$", 1).try_cast(kind)

    return last.select(page("record_id").alias("page_id"), "payload_bytes", "sha1_so_far", "record_type", page("refers_to").alias("refers_to"))


def report(pages: DataFrame, **options) -> DataFrame:
    """The records read back, with the digest in base32."""
    found = round_trip(pages, **options)
    return found.select("page_id", "payload_bytes", base32(F.col("sha1_so_far")).alias("payload_digest"), "record_type", "refers_to")


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a hex digest: eight groups of twenty bits, four letters each."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

    def group(i: int) -> list[Column]:
        bits = F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 10).cast("int")
        return [F.substring(F.lit(letters), F.shiftright(bits, k).bitwiseAND(31) + 1, F.lit(1)) for k in (15, 10, 5, 0)]

    return F.concat(*[c for i in range(8) for c in group(i)])
