"""WARC records in seekable Zstandard bundles, and an index from record identifiers to offsets inside frames.

A bundle is a row of independent Zstandard frames, each with whole records, and ends with a seek table in a skippable frame
(sizes and checksums of all frames). The index says for each record its bundle, its frame, and where in the frame's plain
bytes it lies; so one record costs one seek and one frame. Any Zstandard reader can read a bundle from the start.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.common import fan_out, folder, fresh_folder, lean, publish, rows_of, stage

#: Plain bytes after which a frame and a bundle close.
FRAME_BYTES, BUNDLE_BYTES = 1 << 18, 1 << 24
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the seekable format: the skippable frame's magic number, the footer's, and the flag for checksums.
_SKIPPABLE, _SEEKABLE, _CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, bundle string, frame long, frame_offset long, record_bytes long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool) -> bytes:
    """One record: the whole response, or the response's head alone if it revisits ``first``."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or 'about:blank', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(first)}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """The record at a place: its headers in lower case, its block, and the place after it; ValueError if it is damaged."""
    end = data.find(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8").split("\r\n")
    if end < 0 or lines[0] != "WARC/1.1":
        raise ValueError("no record begins here")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    start = end + 4
    stop = start + int(headers["content-length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("the record's end is not where its length says")
    return headers, data[start:stop], stop + 4


def page_row(headers: dict[str, str], block: bytes) -> tuple[int | None, int, str, str, int | None]:
    """A record as a row of RECORDS. A response's digest is made anew and must agree with its header."""
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError("the payload doesn't agree with its digest")
    return _page_id(headers["warc-record-id"]), size, digest, kind, _page_id(headers.get("warc-refers-to"))


class Bundle:
    """Builds one bundle in memory."""

    def __init__(self, frame_bytes: int, level: int) -> None:
        import zstandard

        self._zip = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frame_bytes, self.frames, self.table = frame_bytes, [], []
        self.open = bytearray()
        self.plain = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Where the record lies: its frame, and its offset there."""
        if self.open and len(self.open) + len(data) > self.frame_bytes:
            self.close_frame()
        at = len(self.open)
        self.open += data
        self.plain += len(data)
        return len(self.frames), at

    def close_frame(self) -> None:
        import xxhash

        data = bytes(self.open)
        packed = self._zip.compress(data)
        self.frames.append(packed)
        self.table.append(struct.pack("<III", len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.open = bytearray()

    def close(self) -> bytes:
        if self.open:
            self.close_frame()
        body = b"".join(self.table) + struct.pack("<IBI", len(self.table), _CHECKSUMS, _SEEKABLE)
        return b"".join((*self.frames, struct.pack("<II", _SKIPPABLE, len(body)), body))


class Seekable:
    """Reads single frames of a bundle by its seek table."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file = file
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != _SEEKABLE or not flags & _CHECKSUMS:
            raise ValueError("no seek table at the end")
        entries = file.read_at(12 * n, size - 9 - 12 * n)
        self.frames, at = [], 0
        for packed, plain, check in struct.iter_unpack("<III", entries):
            self.frames.append((at, packed, plain, check))
            at += packed

    def frame(self, k: int) -> bytes:
        import xxhash
        import zstandard

        at, packed, plain, check = self.frames[k]
        data = zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=max(plain, 1))
        if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} doesn't agree with the seek table")
        return data


def mark_revisits(pages: DataFrame, key: str, url: str, html: str, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest (hex SHA-1), first (the largest key of those with the payload), revisit.

    Of equal payloads of at least ``min_bytes`` bytes, that with the largest key is the response. Rows that share the largest
    key are all responses. A null key revisits the largest one, if there is one.
    """
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= min_bytes
    many = rows.where(large).groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").select("digest", "first")
    # A payload that a third of all rows share is one row here; AQE splits its side of the join.
    revisit = F.coalesce(large & ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    return rows.join(many, "digest", "left").withColumn("revisit", revisit)


def write_bundles(marked: DataFrame, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = LEVEL) -> DataFrame:
    """Writes the records of ``mark_revisits`` as bundles in the shared folder and returns the staged index.

    A task holds one bundle. The index names the bundles of the attempts that Spark has committed, others are never read.
    """
    to = fresh_folder(marked.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        bundle, rows = Bundle(frame_bytes, level), []

        def close() -> pa.RecordBatch:
            path = publish(to, f"pages-{part:05d}-{seq:05d}.warc.zst", bundle.close())
            return pa.RecordBatch.from_pydict({"page_id": pa.array([r[0] for r in rows], pa.int64()), "bundle": [path] * len(rows), "frame": [r[1] for r in rows], "frame_offset": [r[2] for r in rows], "record_bytes": [r[3] for r in rows]})

        for batch in batches:
            for page_id, url, payload, digest, first, revisit in rows_of(batch, ["page_id", "url", "payload", "digest", "first", "revisit"], 64):
                data = record(page_id, url, payload, base64.b32encode(bytes.fromhex(digest)).decode(), first, revisit)
                rows.append((page_id, *bundle.add(data), len(data)))
                if bundle.plain >= bundle_bytes:
                    yield close()
                    bundle, rows, seq = Bundle(frame_bytes, level), [], seq + 1
        if rows:
            yield close()

    return stage(marked.select("page_id", "url", "payload", "digest", "first", "revisit").mapInArrow(lean(write), INDEX), "warc-index")


def read_bundles(index: DataFrame) -> DataFrame:
    """All records of the index's bundles, read from the bundles themselves frame by frame."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (path,) in rows_of(batch, ["bundle"]):
                store, name = folder(path)
                with store.open_input_file(name) as f:
                    seek = Seekable(f)
                    for k in range(len(seek.frames)):
                        data, at, rows = seek.frame(k), 0, []
                        while at < len(data):
                            headers, block, at = parse(data, at)
                            rows.append(page_row(headers, block))
                        yield _record_batch(rows)

    # By ranges: the optimizer would drop a second hash by bundle after distinct, and the few rows would end up in one task.
    return index.select("bundle").distinct().repartitionByRange(fan_out(index.sparkSession), "bundle").mapInArrow(lean(read), RECORDS)


def fetch(index: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The records of the given identifiers, by seeking: only the frames that hold them are read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, frame, places in rows_of(batch, ["bundle", "frame", "places"]):
                store, name = folder(path)
                with store.open_input_file(name) as f:
                    data = Seekable(f).frame(frame)
                yield _record_batch([page_row(*parse(data, p)[:2]) for p in places])

    wanted = index.join(ids.select(F.col(key).alias("page_id")).distinct(), "page_id", "left_semi")
    frames = wanted.groupBy("bundle", "frame").agg(F.collect_list("frame_offset").alias("places"))
    return frames.repartitionByRange(fan_out(index.sparkSession), "bundle", "frame").mapInArrow(lean(read), RECORDS)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)
