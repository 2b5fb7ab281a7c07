"""WARC archives in seekable Zstandard bundles.

A task writes its records into bundles: records are grouped into independent frames, and a footer holds the seek table (a
skippable frame with each frame's sizes, as in the public seekable format). The index maps a record's identifier to its bundle, frame
and offset inside the frame, so one record is read by decompressing one frame.

Of records with equal payloads of at least least_bytes bytes the one with the least id is a response and the others are
revisits; smaller payloads are all responses. Rows without an id come after those with one; rows that repeat the least id are
responses all. Null payloads are empty ones; null addresses are empty ones.

Each attempt of a task writes bundles under names of its own and moves them into place when they are whole. The index holds the
committed attempt's names, and only what it names is read: what other attempts left is never looked at. A record's identifier comes from its page's
id, so rows that repeat an id share it; a row without one gets one of its bundle and place. Control characters in ids and addresses are escaped. Other columns are ignored,
and an empty table gives an empty index.
"""
from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, materialise, record_batches, scratch

FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 256 << 20
#: Least ids of repeated payloads are broadcast up to this many rows.
BROADCAST_ROWS = 500_000
#: Places that a repeated payload's least id goes to beyond that.
SALTS = 32
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: str | None) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}"


def escaped(text: str) -> str:
    """One line of a header, and the text itself again by unquote()."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in "%\x7f" else c for c in text)


def record(page_id: str | None, url: str, payload: bytes, digest: str, first: str | None, name: str | None = None) -> bytes:
    """name: the record's identifier, if not its page's. A response, or where first is another page's id a revisit of it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if first is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <{name or record_id(page_id)}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {escaped(page_id)}")
    if first is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_id(first)}>", f"X-Refers-To-Page: {escaped(first)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class BundleWriter:
    """Frames of records in one file; append() returns (frame, offset in frame)."""

    def __init__(self, out):
        self.out, self.frames, self.buffer, self.size = out, [], bytearray(), 0
        self.packer = zstandard.ZstdCompressor(level=3, write_content_size=True, write_checksum=True)

    def append(self, data: bytes) -> tuple[int, int]:
        if self.buffer and len(self.buffer) + len(data) > FRAME_BYTES:
            self.flush()
        at = len(self.frames), len(self.buffer)
        self.buffer += data
        return at

    def flush(self) -> None:
        if self.buffer:
            packed = self.packer.compress(bytes(self.buffer))
            self.out.write(packed)
            self.frames.append((len(packed), len(self.buffer)))
            self.size += len(packed)
            self.buffer.clear()

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Random access to a bundle's frames by its seek table."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        foot = source.read_at(9, size - 9)
        n, flags, magic = struct.unpack("<IBI", foot)
        if magic != SEEKABLE or flags & 0x7C:
            raise ValueError("no seek table")
        width = 12 if flags & 0x80 else 8
        table = source.read_at(n * width, size - 9 - n * width)
        self.frames, at = [], 0
        for i in range(n):
            packed, plain = struct.unpack_from("<II", table, i * width)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, i: int) -> bytes:
        at, packed, plain = self.frames[i]
        return zstandard.ZstdDecompressor().decompress(self.source.read_at(packed, at), max_output_size=plain)

    def record(self, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
        return next(records(io.BytesIO(self.frame(frame)[offset:])))


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode().rstrip("\r\n").partition(": ")
            headers[k] = v
        block = stream.read(int(headers["Content-Length"]))
        if len(block) != int(headers["Content-Length"]):
            raise ValueError("a record is cut short")
        yield headers, block


def unquoted(text: str | None) -> str | None:
    return None if text is None else unquote(text)


def _place(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


INDEX = "record_id string, page_id string, bundle string, frame int, offset int, length int"


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Write a record for each row of pages into bundles in folder, a URI that all executors reach; returns the index."""
    spark = pages.sparkSession
    bounded_batches(spark)
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    base = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"), payload.alias("_payload"), F.sha1(payload).alias("_sha1"))
    firsts = base.where(F.octet_length("_payload") >= least_bytes).groupBy("_sha1").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1 AND _first IS NOT NULL").select(F.col("_sha1").alias("_key"), "_first")
    firsts = materialise(firsts, "firsts")
    other = F.when(~F.col("_first").eqNullSafe(F.col("_id")), F.col("_first").cast("string"))
    same = (F.col("_sha1") == F.col("_key")) & (F.octet_length("_payload") >= least_bytes)
    if firsts.count() <= broadcast_rows:
        joined = base.join(F.broadcast(firsts), same, "left")
    else:  # a payload that many pages have goes to SALTS places
        salted = firsts.withColumn("_place", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = base.withColumn("_salt", F.pmod(F.xxhash64("_id", "_url"), F.lit(SALTS)).cast("int")).join(salted, same & (F.col("_salt") == F.col("_place")), "left")
    rows = joined.select(F.col("_id").cast("string").alias("_id"), "_url", "_payload", other.alias("_other"))

    def run(it):
        task = TaskContext.get()
        fs, base_path = _place(folder)
        fs.create_dir(base_path, recursive=True)
        writer, name, own, part = None, "", "", 0

        def close():
            writer.close()
            fs.move(own, f"{base_path}/{name}")

        for b in record_batches(it):
            out = []
            for i, url, data, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), as_bytes(b.column(2)), b.column(3).to_pylist(), strict=True):
                if writer is None:
                    name = f"{task.partitionId():06d}-{part:04d}-{task.taskAttemptId()}-{uuid.uuid4().hex}.warc.zst"
                    own = f"{base_path}/.{name}"
                    writer, part = BundleWriter(fs.open_output_stream(own, compression=None)), part + 1
                url = (url or "").replace("\r", "%0D").replace("\n", "%0A")
                own_id = record_id(i) if i is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'row:{name}:{len(writer.frames)}:{len(writer.buffer)}')}"
                rec = record(i, url, data, base32_sha1(data), first, own_id)
                frame, offset = writer.append(rec)
                out.append((own_id, i, name, frame, offset, len(rec)))
                if writer.size > BUNDLE_BYTES:
                    close()
                    writer = None
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32()), strict=True)], ["record_id", "page_id", "bundle", "frame", "offset", "length"])
        if writer is not None:
            close()

    return materialise(rows.mapInArrow(run, INDEX), "warc-index")


def read(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of each record in the bundles that index names.
    A response's digest is taken from what was read, and it must be the one in its header."""
    names = index.select("bundle").distinct()
    names = names.repartition(max(1, names.count()), "bundle")

    def run(it):
        fs, base_path = _place(folder)
        for b in it:
            for name in b.column(0).to_pylist():
                with fs.open_input_file(f"{base_path}/{name}") as source:
                    bundle = BundleReader(source)
                    for k in range(len(bundle.frames)):
                        out = []
                        for headers, block in records(io.BytesIO(bundle.frame(k))):
                            head, _, body = block.partition(b"\r\n\r\n")
                            size = int(head.rpartition(b"Content-Length: ")[2])
                            kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                            if kind == "response" and (len(body) != size or base32_sha1(body) != digest):
                                raise ValueError(f"{name}: a payload differs from its digest")
                            out.append((unquoted(headers.get("X-Page-ID")), headers["WARC-Target-URI"], size, digest, kind, unquoted(headers.get("X-Refers-To-Page"))))
                        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64() if j == 2 else pa.string()) for j in range(6)], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return names.mapInArrow(run, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write pages into bundles in the shared folder and read them back; ids have their own type again."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    kind = dict(pages.dtypes)[id_col]
    got = read(spark, folder, write(pages, folder, id_col, url_col, html_col, least_bytes))
    return got.select(F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
