"""Archives: round trip, dictionary frame, and what the reader refuses."""

import base64
import hashlib
import io
import struct

import pytest
import zstandard

from corpus_rows import rows  # noqa: F401

from snapmerge.llm import warc


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def _want(rows, least=0):
    largest = {}
    for i, _, h in rows:
        raw = (h or "").encode()
        if len(raw) >= least and i is not None:
            largest[raw] = max(largest.get(raw, i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = largest.get(raw)
        again = first is not None and i != first
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first if again else None))
    return out


ROWS = [(i, f"http://h/{i}", f"<p>page {i % 7} é</p>" * (i % 5 + 1)) for i in range(60)] + [
    (100, None, None), (101, "", ""), (102, "http://x/ a\r\nb", "<p>\r\n\r\n</p>"), (103, "u", "x" * 300_000), (None, "n", "no id"), (None, "n", "<p>page 0 é</p>"),
    (59, "http://h/59", "<p>page 3 é</p>" * 5), (3, "again", "<p>page 3 é</p>" * 4)]


@pytest.mark.parametrize("least", [0, 40])
def test_round_trip(spark, least):
    got = warc.round_trip(_pages(spark, ROWS).repartition(3), min_payload=least).collect()
    assert sorted(map(str, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got))) == sorted(map(str, _want(ROWS, least)))
    raw = {(i, (h or "").encode()) for i, _, h in ROWS}
    assert all((r.page_id, bytes(r.payload)) in raw for r in got if r.record_type == "response")


def test_many_archives_and_empty_table(spark, tmp_path):
    pages = _pages(spark, ROWS)
    manifest = warc.write_archives(warc.typed(pages), str(tmp_path / "a"), archive_bytes=1)
    assert manifest.count() > 1 and manifest.agg({"records": "sum"}).first()[0] == len(ROWS)
    stray = tmp_path / "a" / "stray.warc.zst"
    stray.write_bytes(b"left by an attempt that was lost")
    assert warc.read_archives(manifest).count() == len(ROWS)
    assert warc.round_trip(pages.limit(0)).count() == 0


def _archive(records):
    class Out(io.BytesIO):
        def close(self):
            pass
    out = Out()
    w = warc.ArchiveWriter(out)
    for r in records:
        w.add(r)
    w.close()
    return out.getvalue()


def _record(i=1, payload=b"<p>hello</p>"):
    return warc.record_bytes(i, "http://u", payload, None, False, "2024-01-01T00:00:00Z")


def test_frames_one_per_record():
    records = [_record(i, f"<p>{i} some text of a page</p>".encode() * 9) for i in range(500)]
    raw = _archive(records)
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D
    assert list(warc.read_frames(io.BytesIO(raw), chunk=7)) == records
    squeezed = zstandard.ZstdCompressor().compress(raw[8:8 + size])
    assert list(warc.read_frames(io.BytesIO(struct.pack("<II", magic, len(squeezed)) + squeezed + raw[8 + size:]))) == records


@pytest.mark.parametrize("broken", [
    lambda r: r.replace(b"WARC/1.1", b"HTTP/1.1", 1), lambda r: r.replace(b"WARC-Date: ", b"WARC-Dite: "), lambda r: r[:-5] + r[-4:],
    lambda r: r.replace(b"<p>hello", b"<p>hullo"), lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: revisit"), lambda r: r + b"x"])
def test_broken_records_are_refused(broken):
    warc.parse_record(_record())
    with pytest.raises(ValueError):
        warc.parse_record(broken(_record()))


def test_broken_archives_are_refused():
    raw = _archive([_record(i) for i in range(30)])
    for bad in (raw[4:], raw[:6], raw[:-3]):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.read_frames(io.BytesIO(bad)))
