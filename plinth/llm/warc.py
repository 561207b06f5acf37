"""Web archive records in seekable Zstandard bundles.

Records are grouped into independent frames, frames into bundles. A bundle ends with a seek table in a skippable frame
(the Zstandard seekable format: compressed and decompressed size and checksum of each frame, number of frames, magic
number), so any reader of that format can open it and any plain decoder can read it through. The index maps each
record's identifier to its frame, the frame's place in the bundle, and the record's place within the frame; reading one
record decompresses one frame.

A record's identifier (its WARC-Record-ID) is made of the page's id, url and content, so null and repeated ids can be
told apart. Only rows that are equal in all three share one; whichever place it leads to holds the same record.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAME_BYTES = 1 << 17
BUNDLE_BYTES = 4 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_INDEX = "record_id string, page_id long, frame int, frame_offset long, frame_size int, record_offset int, record_size int"
_SCHEMA = f"bundle string, n_records int, data binary, entries array<struct<{_INDEX.replace(' string', ':string').replace(' long', ':bigint').replace(' int', ':int')}>>"


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    """Identifier of the record of this page, address and block digest; null isn't the same as empty."""
    name = "\x1f".join("-" if x is None else f"={x}" for x in (page_id, url, digest))
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}"


def identified(page_id: int | None, url: str | None, html: str | None, date: str = DATE) -> tuple[str, bytes]:
    """(identifier, WARC resource record); null html gives an empty block, a null url no target."""
    block = (html or "").encode("utf-8", "surrogatepass")
    digest = hashlib.sha256(block).hexdigest()
    own = record_id(page_id, url, digest)
    head = ["WARC/1.1", "WARC-Type: resource", f"WARC-Record-ID: <{own}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {' '.join(url.split())}")
    head += [f"WARC-Block-Digest: sha256:{digest}", "Content-Type: text/html", f"Content-Length: {len(block)}"]
    return own, "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def record(page_id: int | None, url: str | None, html: str | None, date: str = DATE) -> bytes:
    """One WARC resource record."""
    return identified(page_id, url, html, date)[1]


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one record; raises if the block's digest is wrong."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError("the record's digest is wrong")
    return headers, block


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    """The skippable frame for frames of (compressed size, size, checksum)."""
    body = b"".join(struct.pack("<III", *f) for f in frames) + struct.pack("<IBI", len(frames), 0x80, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


def read_seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame, from the bundle's last bytes."""
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != _SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    begin = len(data) - 9 - count * width
    out, at = [], 0
    for k in range(count):
        packed, size = struct.unpack_from("<II", data, begin + k * width)
        out.append((at, packed, size))
        at += packed
    return out


def read_record(data: bytes, frame: int, record_offset: int, record_size: int) -> bytes:
    import zstandard

    at, packed, size = read_seek_table(data)[frame]
    return zstandard.ZstdDecompressor().decompress(data[at : at + packed], max_output_size=size)[record_offset : record_offset + record_size]


class _Bundle:
    def __init__(self, level: int) -> None:
        import xxhash
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
        self.checksum = lambda raw: xxhash.xxh64(raw).intdigest() & 0xFFFFFFFF
        self.parts: list[bytes] = []
        self.frames: list[tuple[int, int, int]] = []
        self.entries: list[dict] = []
        self.open: list[bytes] = []
        self.waiting: list[tuple] = []
        self.size = self.filled = 0

    def add(self, own: str, page_id: int | None, raw: bytes) -> None:
        self.waiting.append((own, page_id, self.filled, len(raw)))
        self.open.append(raw)
        self.filled += len(raw)

    def close_frame(self) -> None:
        if not self.open:
            return
        raw = b"".join(self.open)
        packed = self.pack(raw)
        self.entries += [{"record_id": own, "page_id": p, "frame": len(self.frames), "frame_offset": self.size, "frame_size": len(packed), "record_offset": at, "record_size": n} for own, p, at, n in self.waiting]
        self.frames.append((len(packed), len(raw), self.checksum(raw)))
        self.parts.append(packed)
        self.size += len(packed)
        self.open, self.waiting, self.filled = [], [], 0

    def row(self) -> dict:
        data = b"".join([*self.parts, seek_table(self.frames)])
        return {"bundle": f"{hashlib.sha256(data).hexdigest()[:24]}.warc.zst", "n_records": len(self.entries), "data": data, "entries": self.entries}


def _bundle(batches: Iterator[pa.RecordBatch], frame_bytes: int, bundle_bytes: int, level: int, date: str) -> Iterator[pa.RecordBatch]:
    entry = pa.struct([("record_id", pa.string()), ("page_id", pa.int64()), ("frame", pa.int32()), ("frame_offset", pa.int64()), ("frame_size", pa.int32()), ("record_offset", pa.int32()), ("record_size", pa.int32())])
    schema = pa.schema([("bundle", pa.string()), ("n_records", pa.int32()), ("data", pa.binary()), ("entries", pa.list_(entry))])
    now = _Bundle(level)
    for batch in batches:
        for page_id, url, html in zip(*(batch.column(k).to_pylist() for k in ("page_id", "url", "html")), strict=True):
            own, raw = identified(page_id, url, html, date)
            now.add(own, page_id, raw)
            if now.filled >= frame_bytes:
                now.close_frame()
                if now.size >= bundle_bytes:
                    yield pa.RecordBatch.from_pylist([now.row()], schema)
                    now = _Bundle(level)
    now.close_frame()
    if now.entries:
        yield pa.RecordBatch.from_pylist([now.row()], schema)


def warc_bundles(pages: DataFrame, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = LEVEL, date: str = DATE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(bundle, n_records, data, entries): bundles with their index; no shuffle, each partition fills its own bundles.

    A frame closes at ``frame_bytes`` of records, a bundle at ``bundle_bytes``; a longer record has a frame of its own
    size. Which records share a bundle goes by the table's partitions and their order; a bundle is named after its
    content, so a task that runs again over the same partition makes the same bundles. Null html and urls give records
    without block or target, a null id an entry without page_id; repeated rows are archived each. An empty table
    gives no bundle. Other columns are ignored.
    """
    return pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html")).mapInArrow(
        partial(_bundle, frame_bytes=frame_bytes, bundle_bytes=bundle_bytes, level=level, date=date), _SCHEMA
    )


def record_index(bundles: DataFrame) -> DataFrame:
    """One row per record: its identifier, its bundle and its place there."""
    return bundles.select("bundle", F.explode("entries").alias("e")).select("bundle", "e.*")


def find_records(bundles: DataFrame, wanted: DataFrame) -> DataFrame:
    """(record_id, bundle, record): the records of the identifiers in ``wanted`` (record_id), each read by one frame."""
    places = record_index(bundles).join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    asked = places.groupBy("bundle").agg(F.collect_list(F.struct("record_id", "frame", "record_offset", "record_size")).alias("asked"))
    return bundles.select("bundle", "data").join(asked, "bundle").mapInArrow(_read, "record_id string, bundle string, record binary")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(a["record_id"], name, read_record(data, a["frame"], a["record_offset"], a["record_size"])) for name, data, asked in zip(*(batch.column(k).to_pylist() for k in ("bundle", "data", "asked")), strict=True) for a in asked]
        if rows:
            own, name, raw = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array(name, pa.string()), pa.array(raw, pa.binary())], names=["record_id", "bundle", "record"])


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, data in zip(batch.column("bundle").to_pylist(), batch.column("data").to_pylist(), strict=True):
            part = f"{folder}/.{name}.{uuid.uuid4().hex}"
            with open(part, "wb") as f:
                f.write(data)
            os.replace(part, f"{folder}/{name}")
        yield pa.RecordBatch.from_arrays([batch.column("bundle")], names=["bundle"])


def write_bundles(bundles: DataFrame, folder: str) -> DataFrame:
    """Writes each bundle as a file of a folder that all executors mount; gives their names. Safe to repeat."""
    return bundles.select("bundle", "data").mapInArrow(partial(_write, folder=folder), "bundle string")
