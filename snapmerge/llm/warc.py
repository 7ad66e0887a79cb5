"""WARC archives with Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing.  Of records with equal payloads (SHA-1) of at least ``min_payload`` bytes the one with the largest page_id is
a ``response``; the others are ``revisit`` records that refer to it.  Each archive starts with a skippable frame that
holds a dictionary made from the archive's first records, followed by one frame per record.  Every attempt of a task
writes files of its own name; only files that the staged manifest lists belong to the result, so a task that runs
twice leaves a stray file but no doubled record.

Reading.  The dictionary is loaded from the skippable frame (plain or itself compressed), frames are decoded one at a
time from a stream, and each record's version, mandatory headers, block length, digests and end are checked.

Null html is the empty payload; null page_id sorts below all others and stays null, null url leaves its header out;
control characters in a url are percent-encoded; of rows that share the largest page_id of a payload all are responses;
an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmerge.llm import common as C

#: compressed bytes after which a new archive is begun
ARCHIVE_BYTES = 32 << 20
#: records and bytes that an archive's dictionary is made from, and its size
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 4 << 20, 64 << 10
LEVEL = 6
SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme, as Hadoop resolves it."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    full = fs.makeQualified(p).toString()
    return "file://" + full[5:] if full.startswith("file:/") and not full.startswith("file://") else full


def open_file(uri: str, write: bool):
    """A stream on a file of any file system that Arrow knows (local, HDFS, object stores)."""
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(uri)
    if write:
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(path)
    return system.open_input_stream(path)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    if not urn.startswith("<urn:page:") or not urn.endswith(">"):
        raise ValueError(f"record id {urn!r}")
    text = urn[10:-1]
    return None if text == "none" else int(text)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record: an HTTP response, or a revisit that leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if c.isprintable() and c != " " else "".join(f"%{x:02X}" for x in c.encode()) for c in url)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    head += [("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The checked fields of a record; ValueError tells what is wrong."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields: dict[str, str] = {}
    for x in lines[1:]:
        k, colon, v = x.partition(":")
        if not colon or not k.strip():
            raise ValueError(f"header line {x[:40]!r}")
        fields[k.strip().lower()] = v.strip()
    for k in MANDATORY:
        if k.lower() not in fields:
            raise ValueError(f"header {k} is missing")
    size = int(fields["content-length"])
    if size < 0 or len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {size}, but {len(rest) - 4} bytes in the block")
    block = rest[:size]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError("block digest differs")
    http, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("the block is no HTTP response")
    length = next((int(x.split(b":")[1]) for x in http.split(b"\r\n")[1:] if x.lower().startswith(b"content-length:")), None)
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if length not in (None, len(payload)) or digest and digest != base32_sha1(payload):
            raise ValueError("payload length or digest differs")
    elif kind != "revisit" or payload or length is None or not digest or "warc-refers-to" not in fields:
        raise ValueError(f"a {kind} record that is not complete")
    return {"record_type": kind, "page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
            "refers_to": _page(fields["warc-refers-to"]) if kind == "revisit" else None, "payload_digest": digest,
            "payload_bytes": len(payload) if length is None else length, "payload": payload if kind == "response" else None}


def make_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples' start where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


class ArchiveWriter:
    """Writes records as frames; the dictionary is made when enough records have come, or at the end."""

    def __init__(self, out):
        self.out, self.waiting, self.size, self.records, self.packer = out, [], 0, 0, None

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.packer is not None:
            self._write(self.packer.compress(record))
            return
        self.waiting.append(record)
        if len(self.waiting) >= SAMPLE_RECORDS or sum(map(len, self.waiting)) >= SAMPLE_BYTES:
            self._start()

    def _start(self) -> None:
        raw = make_dictionary(self.waiting)
        self._write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None, write_checksum=True, write_content_size=True)
        for r in self.waiting:
            self._write(self.packer.compress(r))
        self.waiting = []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        if self.packer is None:
            self._start()
        self.out.close()


def read_frames(stream, chunk: int = 64 << 10) -> Iterator[bytes]:
    """The records of an archive, one decoded frame each."""
    def exactly(n: int) -> bytes:
        parts, left = [], n
        while left:
            got = stream.read(left)
            if not got:
                raise ValueError("the archive ends in its dictionary")
            parts.append(bytes(got))
            left -= len(got)
        return b"".join(parts)

    magic, size = struct.unpack("<II", exactly(8))
    if magic != SKIPPABLE:
        raise ValueError("no leading skippable frame")
    raw = exactly(size)
    if raw[:4] == ZSTD_MAGIC:
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    left, frame, out = b"", None, io.BytesIO()
    while True:
        data, left = left, b""
        if not data:
            data = bytes(stream.read(chunk))
        if not data:
            if frame is not None:
                raise ValueError("the archive ends inside a frame")
            return
        frame = frame or unpacker.decompressobj()
        out.write(frame.decompress(data))
        if frame.eof:
            left, frame = frame.unused_data, None
            yield out.getvalue()
            out = io.BytesIO()


def typed(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """page_id, url, html plus refers_to and revisit."""
    body = F.coalesce("html", F.lit(""))
    marked = pages.select("page_id", "url", body.alias("html"), F.sha1(body.cast("binary")).alias("sha"), F.octet_length(body).alias("size"))
    copies = (marked.where(F.col("size") >= min_payload).groupBy("sha").agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
              .where("n > 1").select("sha", "first"))
    copies = C.stage(copies, "warc-copies")
    joined = marked.join(copies, "sha", "left")
    again = F.col("first").isNotNull() & (F.col("size") >= min_payload) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", F.when(again, F.col("first")).alias("refers_to"), again.alias("revisit"))


def write_archives(records: DataFrame, folder: str, date: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives into ``folder``; returns the staged manifest (path, records, bytes)."""
    spark = records.sparkSession
    C.ship(spark)
    base = qualified(spark, folder)
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches):
        archive, path = None, ""

        def done():
            archive.close()
            return pa.RecordBatch.from_pylist([{"path": path, "records": archive.records, "bytes": archive.size}])

        for b in batches:
            for part in C.slices(b, "html"):
                for r in part.to_pylist():
                    if archive is None:
                        path = f"{base}/{uuid.uuid4().hex}.warc.zst"
                        archive = ArchiveWriter(open_file(path, True))
                    archive.add(record_bytes(r["page_id"], r["url"], r["html"].encode(), r["refers_to"], r["revisit"], date))
                    if archive.size >= archive_bytes:
                        yield done()
                        archive = None
        if archive is not None:
            yield done()

    return C.stage(records.select("page_id", "url", "html", "refers_to", "revisit").mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


RECORD = "record_type string, page_id long, url string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def read_archives(manifest: DataFrame) -> DataFrame:
    """All records of the archives that the manifest lists, checked; one task reads an archive as a stream."""
    C.ship(manifest.sparkSession)
    schema = pa.schema([("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("refers_to", pa.int64()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def read(batches):
        for b in batches:
            for path, expected in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows, held, n = [], 0, 0
                with open_file(path, False) as stream:
                    for raw in read_frames(stream):
                        rows.append(parse_record(raw))
                        held, n = held + len(raw), n + 1
                        if held >= C.SLICE_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if n != expected:
                    raise ValueError(f"{path} holds {n} records, its manifest says {expected}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = max(1, min(manifest.count(), 100_000))
    return manifest.select("path", "records").repartition(files, "path").mapInArrow(read, RECORD)


def round_trip(pages: DataFrame, folder: str | None = None, min_payload: int = 0) -> DataFrame:
    """Write ``pages`` to archives and read them back."""
    folder = folder or f"{C.scratch_root(pages.sparkSession)}/llm/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(typed(pages, min_payload), folder))
