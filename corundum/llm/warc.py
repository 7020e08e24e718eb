"""WARC archives as a chunked record table.

``write_archives`` cuts payloads into rows of record and chunk number of at most CHUNK bytes, which a task streams into
archives of one gzip member per record; ``read_chunks`` streams archives back as such rows, each with the digest of all bytes so
far. Neither holds a record whole: what a task holds is a batch of chunk rows (spark.sql.execution.arrow.maxBytesPerBatch).
Records of equal payloads are one response, that with the largest id, and revisits to it.

Files are written with the file systems of Arrow (local, s3 also by the names s3a and s3n, hdfs, viewfs, abfs, gs), and go to the folder that driver and executors share, under names no two attempts of a task have in common; only files in the
manifest that finished tasks return are read, so lost executors leave nothing half-written in the result.

Null html is an empty payload; a null url writes no target; rows that repeat an id and its payload are all responses; a null id is
never the response while another id has the payload; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corundum.llm._spark import cut, small

CHUNK = 1 << 18
#: An archive that has reached so many bytes is closed and the next one begun.
ARCHIVE = 64 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
MANIFEST = "path string, records bigint, bytes bigint"
CHUNKS = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target", pa.string()), ("chunk_no", pa.int64()), ("data", pa.binary()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("last", pa.bool_())])


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _header(page_id, url, size: int, digest: str, response) -> bytes:
    revisit = response is not None
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{'none' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(HTTP) + (0 if revisit else size)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += [f"WARC-Refers-To: <urn:x-page:{response}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def filesystem(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """Arrow's file system of a Hadoop URI, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", folder))


class Archive:
    """Writes records, a chunk at a time, to archives of about ARCHIVE bytes."""

    def __init__(self, folder: str):
        (self.fs, self.root), self.out, self.done = filesystem(folder), None, []

    def begin(self, header: bytes) -> None:
        if self.out is None:
            self.fs.create_dir(self.root, recursive=True)
            self.path, self.n, self.size = f"{self.root}/{uuid.uuid4().hex}.warc.gz", 0, 0
            self.out = self.fs.open_output_stream(self.path, compression=None)
        self.pack = zlib.compressobj(1, wbits=31)
        self.add(header)

    def add(self, data) -> None:
        self._write(self.pack.compress(data))

    def end(self) -> None:
        self._write(self.pack.compress(b"\r\n\r\n") + self.pack.flush())
        self.n += 1
        if self.size >= ARCHIVE:
            self.close()

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.path, self.n, self.size))
            self.out = None


def writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = Archive(folder)
        for batch in batches:
            data = batch.column("data")
            for k, (page_id, url, sha1, response, size, no, last) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "sha1", "response", "size", "chunk_no", "last")), strict=True)):
                if not no:
                    archive.begin(_header(page_id, url, size, base32(bytes.fromhex(sha1)), response) + HTTP)
                archive.add(data[k].as_buffer())
                if last:
                    archive.end()
        archive.close()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*archive.done, strict=True) if archive.done else ([], [], []), (pa.string(), pa.int64(), pa.int64()), strict=True)], ["path", "records", "bytes"])

    return write


class Stream:
    """The bytes of a file of gzip members, a little at a time."""

    def __init__(self, file):
        self.file, self.unpack, self.have, self.raw = file, zlib.decompressobj(wbits=31), bytearray(), b""

    def more(self) -> bool:
        while True:
            if self.unpack.eof:
                self.raw, self.unpack = self.unpack.unused_data, zlib.decompressobj(wbits=31)
            elif not self.raw:
                self.raw = self.unpack.unconsumed_tail
            if not self.raw:
                self.raw = self.file.read(CHUNK)
            if not self.raw:
                return False
            got, self.raw = self.unpack.decompress(self.raw, CHUNK), b""
            if got:
                self.have += got
                return True

    def line(self) -> bytes | None:
        while (k := self.have.find(b"\r\n")) < 0:
            if not self.more():
                return None
        out = bytes(self.have[:k])
        del self.have[: k + 2]
        return out

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self.more():
                raise ValueError("an archive ends inside a record")
        out = bytes(self.have[:n])
        del self.have[:n]
        return out


def records(file) -> Iterator[tuple]:
    """The rows of one archive, in the order of CHUNKS."""
    s = Stream(file)
    while (line := s.line()) is not None:
        if not line.startswith(b"WARC/"):
            raise ValueError("a record doesn't begin with its version")
        head = {}
        while line := s.line():
            name, _, value = line.decode().partition(": ")
            head[name.lower()] = value
        page = lambda v: None if v is None or v.endswith("none>") else int(v[len("<urn:x-page:") : -1])
        left = int(head["content-length"])
        while line := s.line():  # the HTTP head ends with an empty line
            left -= len(line) + 2
        left -= 2
        fixed = (page(head["warc-record-id"]), head["warc-type"], page(head.get("warc-refers-to")), head.get("warc-target-uri"))
        named = head["warc-payload-digest"].removeprefix("sha1:")
        if head["warc-type"] == "revisit":
            yield *fixed, 0, b"", int(head["x-payload-length"]), named, True
        else:
            digest, size, no = hashlib.sha1(), 0, 0
            while True:
                data = s.take(min(CHUNK, left))
                left -= len(data)
                size += len(data)
                digest.update(data)
                if not left and base32(digest.digest()) != named:
                    raise ValueError(f"the payload of {head['warc-record-id']} isn't what its digest says")
                yield *fixed, no, data, size, base32(digest.copy().digest()), not left
                no += 1
                if not left:
                    break
        s.take(4)


def reader(folder: str, with_data: bool):
    schema = CHUNKS if with_data else CHUNKS.remove(CHUNKS.get_field_index("data"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as file:
                    for row in records(file):
                        held += len(row[5])
                        rows.append(row if with_data else row[:5] + row[6:])
                        if len(rows) >= 4096 or with_data and held >= 16 * CHUNK:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return read


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write a record per page; the manifest (path, records, bytes). Payloads under `least` bytes are all responses."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    p = pages.select("page_id", "url", body.alias("body"), F.sha1(body).alias("sha1"), F.octet_length(body).cast("long").alias("size"))
    # Only the digests that several pages have are joined back, and broadcast if they are few; payloads stay where they are.
    shared = cut(p.groupBy("sha1").agg(F.count("*").alias("n"), F.max("page_id").alias("response")).where("n > 1").select("sha1", "response"))
    other = F.when((F.col("size") >= least) & F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    p = p.join(small(shared), "sha1", "left").withColumn("response", other)
    chunks = F.when(F.col("response").isNotNull() | (F.col("size") == 0), 1).otherwise(F.ceil(F.col("size") / CHUNK)).cast("int")
    parts = F.transform(F.sequence(F.lit(0), chunks - 1), lambda k: F.struct(k.alias("chunk_no"), (k == chunks - 1).alias("last"), F.substring("body", k * CHUNK + 1, F.when(F.col("response").isNotNull(), 0).otherwise(CHUNK)).alias("data")))
    rows = p.select("page_id", "url", "sha1", "response", "size", F.explode(parts).alias("x")).select("page_id", "url", "sha1", "response", "size", "x.chunk_no", "x.last", "x.data")
    return cut(rows.mapInArrow(writer(folder), MANIFEST))


def remove_archives(spark: SparkSession, folder: str) -> None:
    """Delete a folder of archives once what was read from them is written elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_chunks(manifest: DataFrame, folder: str, with_data: bool = True) -> DataFrame:
    """(page_id, record_type, refers_to, target, chunk_no, data, bytes_so_far, digest_so_far, last) of all archives."""
    kinds = "page_id bigint, record_type string, refers_to bigint, target string, chunk_no bigint, " + "data binary, " * with_data + "bytes_so_far bigint, digest_so_far string, last boolean"
    n = max(1, manifest.count())
    return manifest.repartition(n, "path").mapInArrow(reader(folder, with_data), kinds)


def record_index(chunks: DataFrame) -> DataFrame:
    """One row per record, from the last of its chunks."""
    return chunks.where("last").select("page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"), "record_type", "refers_to")
