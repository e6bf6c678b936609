"""Operator 6: WARC archives written and read as a table of record chunks.

``write_archives`` writes one gzip archive per task (each record a gzip member
of its own) through ``pyarrow.fs`` into a shared folder and returns a manifest
table.  A task attempt writes a file of its own name; only the files that the
manifest lists count, so a lost executor leaves at most an unused file.

``read_chunks`` streams the archives and yields one row per ``CHUNK`` bytes of
payload: record identifier, chunk number, the bytes (if asked for), and the
size and SHA-1 of the payload up to there.  Neither side holds a whole record:
payloads are compressed, inflated and digested chunk by chunk, and the digest
state travels from chunk to chunk.  The row marked ``last`` has the figures of
the full payload.

Among records of equal payloads of at least ``MIN_REVISIT`` bytes the one with
the largest page_id is the response and the others revisit it.

Edge cases: null html is an empty payload; a null page_id sorts below every
other and is written without a page identifier; repeated rows make repeated
records, and rows that share the largest page_id are all responses; a null url
leaves out the target; an empty table gives no archive; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlens.llm.common import materialize, shared_folder

CHUNK = 1 << 20
MIN_REVISIT = 1000
BATCH_BYTES = 8 << 20
_ID = "urn:x-page:"
#: Fixed values of the format.
VERSION = "WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

MANIFEST = "path string, records long, bytes long"
CHUNKS = ("path string, record_no long, record_id string, record_type string, refers_to string, url string, "
          "header_digest string, header_bytes long, chunk_no long, data binary, "
          "payload_bytes long, payload_digest string, last boolean")


def _uri(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that the session's file system gives it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return re.sub(r"^file:/+", "file:///", full)


def plan_records(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` with payload digest, record type and the page referred to."""
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         payload.alias("payload"))
    pages = pages.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    repeated = (pages.where(F.col("size") >= MIN_REVISIT).groupBy("digest")
                .agg(F.max("page_id").alias("response"), F.count("*").alias("copies"))
                .where("copies > 1 and response is not null").select("digest", "response"))
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return (pages.join(repeated, "digest", "left")
            .select("page_id", "url", "digest", F.col("size").cast("long").alias("size"),
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("response")).alias("refers_to"),
                    F.when(~revisit, F.col("payload")).alias("payload")))


def _heads(page_id, url, digest, size, kind, refers_to) -> tuple[bytes, bytes]:
    """(WARC header, HTTP header) of a record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <{_ID}{'none' if page_id is None else page_id}>",
             f"WARC-Date: {DATE}"]
    if url is not None:
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {clean}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    length = len(http) + (size if kind == "response" else 0)
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "replace"), http


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write the records of ``plan_records`` as archives below ``folder``; return the manifest."""
    uri = _uri(records.sparkSession, folder)

    def write(batches):
        fs, root = pafs.FileSystem.from_uri(uri)
        fs.create_dir(root, recursive=True)
        name = f"{root}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        out, n, size = None, 0, 0
        for batch in batches:
            meta = [batch.column(i).to_pylist() for i in range(6)]
            for i, (page_id, url, digest, length, kind, refers_to) in enumerate(zip(*meta)):
                out = out or fs.open_output_stream(name, compression=None)
                pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                head, http = _heads(page_id, url, digest, length, kind, refers_to)
                size += out.write(pack.compress(head + http)) or 0
                if kind == "response":
                    view = memoryview(batch.column(6)[i].as_buffer())
                    for at in range(0, len(view), CHUNK):
                        out.write(pack.compress(view[at:at + CHUNK]))
                out.write(pack.compress(b"\r\n\r\n") + pack.flush())
                n += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"path": f"{uri.rstrip('/')}/{name.rsplit('/', 1)[1]}", "records": n, "bytes": size}],
                schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return materialize(records.mapInArrow(write, MANIFEST), "warc-manifest")


class _Inflated:
    """Bounded reads from a stream of gzip members, decompressed."""

    def __init__(self, raw):
        self.raw, self.buffer, self.unpack, self.rest = raw, bytearray(), None, b""

    def _fill(self) -> bool:
        if not self.rest:
            self.rest = self.raw.read(CHUNK)
            if not self.rest:
                self.buffer += self.unpack.flush() if self.unpack else b""
                self.unpack = None
                return False
        self.unpack = self.unpack or zlib.decompressobj(31)
        self.buffer += self.unpack.decompress(self.rest, CHUNK)
        if self.unpack.eof:
            self.rest, self.unpack = self.unpack.unused_data, None
        else:
            self.rest = self.unpack.unconsumed_tail
        return True

    def line(self) -> bytes | None:
        """The next line without its end, None at the end of the stream."""
        while (at := self.buffer.find(b"\r\n")) < 0:
            if not self._fill():
                return None
        out = bytes(self.buffer[:at])
        del self.buffer[:at + 2]
        return out

    def some(self, most: int) -> bytes:
        """Up to ``most`` bytes, fewer only at the end of the stream."""
        while len(self.buffer) < most and self._fill():
            pass
        out = bytes(self.buffer[:most])
        del self.buffer[:most]
        return out


def read_archive(raw, with_data: bool = False, chunk: int = CHUNK):
    """Chunk rows (dicts) of one archive stream, in order."""
    stream, number = _Inflated(raw), 0
    while (line := stream.line()) is not None:
        if not line:
            continue
        head = {}
        while line := stream.line():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            head[key.strip().lower()] = value.strip()
        left = int(head["content-length"])
        http_size = None
        while left > 0:
            line = stream.line()
            left -= len(line) + 2
            if not line:
                break
            if line.lower().startswith(b"content-length:"):
                http_size = int(line.split(b":")[1])
        row = {"record_no": number, "record_id": head["warc-record-id"].strip("<>"),
               "record_type": head["warc-type"], "refers_to": head.get("warc-refers-to", "").strip("<>") or None,
               "url": head.get("warc-target-uri"),
               "header_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
               "header_bytes": http_size}
        digest, size, chunk_no = hashlib.sha1(), 0, 0
        while True:
            data = stream.some(min(chunk, left)) if left else b""
            if left and not data:
                raise EOFError(f"archive ends inside record {number}")
            left -= len(data)
            size += len(data)
            digest.update(data)
            yield row | {"chunk_no": chunk_no, "data": data if with_data else None, "payload_bytes": size,
                         "payload_digest": digest.hexdigest(), "last": not left}
            chunk_no += 1
            if not left:
                break
        stream.some(4)  # the two line ends after a record
        number += 1


def read_chunks(manifest: DataFrame, with_data: bool = False) -> DataFrame:
    """One row per payload chunk of the archives that ``manifest(path)`` lists."""
    fields = [f.split() for f in CHUNKS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[t]) for n, t in fields])

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_stream(name, compression=None) as raw:
                    for row in read_archive(raw, with_data):
                        rows.append(row | {"path": path})
                        held += len(row["data"] or b"") + 200
                        if held > BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    spark = manifest.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("path").repartition(n).mapInArrow(read, CHUNKS)


def record_table(chunks: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, intact.

    A response has the figures of the payload that was read, checked against
    its header; a revisit those of its header.
    """
    page = lambda c: F.expr(f"try_cast(substr({c}, {len(_ID) + 1}) as bigint)")
    response = F.col("record_type") == "response"
    return chunks.where("last").select(
        page("record_id").alias("page_id"),
        F.when(response, F.col("payload_bytes")).otherwise(F.col("header_bytes")).alias("payload_bytes"),
        F.when(response, F.col("payload_digest")).otherwise(F.col("header_digest")).alias("payload_digest"),
        "record_type", page("refers_to").alias("refers_to"),
        (~response | ((F.col("payload_digest") == F.col("header_digest"))
                      & (F.col("payload_bytes") == F.col("header_bytes")))).alias("intact"))


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as archives, read them back, and return the record table."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    return record_table(read_chunks(write_archives(plan_records(pages), folder)))
