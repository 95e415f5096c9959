"""Ogg media columns (RFC 3533): write and read the container, verify it and derive timestamps.

The writer cuts a payload of 8-bit samples into blocks, deals them in turn to the logical streams and interleaves the
streams' pages.  The reader verifies every page's checksum, puts packets together from the lacing values, sorts pages to
their streams by serial number and derives each packet's time from the granule positions.

Mapping, one header packet for each stream: ``FT8\\0``, version, stream's index, number of streams, a zero byte, block
size and sample rate (unsigned 32-bit).  A granule position is the number of the payload's samples up to the end of the
last packet that ends on the page, -1 if none does.

Defined cases: a null text is an empty payload, padded to 64 zero bytes like every other; equal payloads, those of repeated rows
too, give equal files; very long texts span many pages; a damaged file raises OggError; a null doc_id is carried; an empty table
gives an empty result.  Columns beside doc_id and text, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import bounded_batches, documents, map_arrow, written

RATE = 8000
BLOCK = 4096
STREAMS = 2
#: Lacing values on one page; the format allows 255.
PAGE_SEGMENTS = 64
CONTINUED, FIRST, LAST = 1, 2, 4
HEAD = struct.Struct("<4sBBqIII")
SETUP = struct.Struct("<4sBBBBII")
REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


class OggError(ValueError):
    pass


def page_crc(page: bytes) -> int:
    """The container's CRC: polynomial 0x04C11DB7, most significant bit first, from 0, not inverted.

    zlib's CRC has the same polynomial, least significant bit first; so both ends are mirrored bit by bit.
    """
    mirrored = zlib.crc32(page.translate(REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(mirrored.to_bytes(4, "little").translate(REVERSED), "big")


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    rest = bytes([len(lacing)]) + lacing + body
    crc = page_crc(HEAD.pack(b"OggS", 0, flags, granule, serial, number, 0) + rest)
    return HEAD.pack(b"OggS", 0, flags, granule, serial, number, crc) + rest


def stream_pages(serial: int, packets: list[tuple[bytes, int]], segments: int = PAGE_SEGMENTS) -> list[tuple[int, bytes]]:
    """(sample position, page) of one logical stream; packets: (bytes, granule position at its end), the header first.

    The header has a page of its own.
    """
    pages, number = [], 0

    def put(lacing: list[int], body: bytes, granule: int, flags: int, at: int) -> None:
        nonlocal number
        pages.append((at, _page(flags | FIRST * (number == 0), granule, serial, number, bytes(lacing), body)))
        number += 1

    put(_lacing(len(packets[0][0])), packets[0][0], 0, LAST * (len(packets) == 1), -1)
    lacing, body, granule, flags, at = [], [], -1, 0, 0
    for k, (data, end) in enumerate(packets[1:], 2):
        values, start = _lacing(len(data)), 0
        while values:
            if len(lacing) == segments:
                put(lacing, b"".join(body), granule, flags, at)
                lacing, body, granule, flags = [], [], -1, CONTINUED * (start > 0)
            take, values = values[: segments - len(lacing)], values[segments - len(lacing) :]
            lacing += take
            body.append(data[start : start + sum(take)])
            start, at = start + sum(take), end
        granule = end
        if k == len(packets):
            put(lacing, b"".join(body), granule, flags | LAST, at)
    return pages


def _lacing(n: int) -> list[int]:
    return [255] * (n // 255) + [n % 255]


def write_ogg(payload: bytes, block: int = BLOCK, streams: int = STREAMS, rate: int = RATE, segments: int = PAGE_SEGMENTS) -> bytes:
    dealt = [[(SETUP.pack(b"FT8\0", 1, i, streams, 0, block, rate), 0)] for i in range(streams)]
    for k, start in enumerate(range(0, len(payload), block)):
        dealt[k % streams].append((part := payload[start : start + block], start + len(part)))
    pages = [(at, i, n, page) for i, packets in enumerate(dealt) for n, (at, page) in enumerate(stream_pages(i + 1, packets, segments))]
    return b"".join(page for *_, page in sorted(pages))


@dataclass
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    #: For each page: packets that end on it, its granule position.
    ends: list[tuple[int, int]] = field(default_factory=list)
    pages: int = 0
    open: list[bytes] | None = None
    last: bool = False


def read_streams(data: bytes) -> dict[int, Stream]:
    """The logical streams by serial number, every page verified."""
    found: dict[int, Stream] = {}
    at, view = 0, memoryview(data)
    while at < len(data):
        if len(data) - at < HEAD.size + 1:
            raise OggError("the file ends within a page header")
        magic, version, flags, granule, serial, number, crc = HEAD.unpack_from(data, at)
        if magic != b"OggS" or version:
            raise OggError(f"no page starts at byte {at}")
        body = at + HEAD.size + 1 + data[at + HEAD.size]
        lacing = data[at + HEAD.size + 1 : body]
        end = body + sum(lacing)
        if end > len(data):
            raise OggError("the file ends within a page")
        if page_crc(data[at:at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != crc:
            raise OggError(f"the page at byte {at} fails its checksum")
        if flags & FIRST:
            if serial in found:
                raise OggError(f"stream {serial} begins twice")
            found[serial] = Stream(serial)
        s = found.get(serial)
        if s is None or s.last or number != s.pages:
            raise OggError(f"page {number} of stream {serial} is out of order")
        if bool(flags & CONTINUED) != (s.open is not None):
            raise OggError(f"page {number} of stream {serial} does not continue its packet")
        s.pages, s.last, ended = s.pages + 1, bool(flags & LAST), 0
        start, size = body, 0
        for value in lacing:
            size += value
            if value < 255:
                s.packets.append(b"".join([*(s.open or ()), view[start : start + size]]))
                start, size, s.open, ended = start + size, 0, None, ended + 1
        if lacing and lacing[-1] == 255:
            s.open = [*(s.open or ()), bytes(view[start : start + size])]
        if (granule == -1) != (ended == 0):
            raise OggError(f"page {number} of stream {serial} has a wrong granule position")
        s.ends.append((ended, granule))
        at = end
    if any(not s.last or s.open for s in found.values()):
        raise OggError("a stream does not end")
    return found


@dataclass
class Media:
    payload: bytes
    rate: int
    streams: int
    pages: int
    packets: int
    #: Of each packet in order of time: (start, end) in samples.
    times: list[tuple[int, int]]


def read_ogg(data: bytes) -> Media:
    streams, blocks, setups = read_streams(data), [], []
    for s in streams.values():
        if not s.packets or len(s.packets[0]) != SETUP.size or s.packets[0][:4] != b"FT8\0":
            raise OggError(f"stream {s.serial} has no header")
        _, _, index, n, _, block, rate = SETUP.unpack(s.packets[0])
        setups.append((index, n, block, rate))
        k = 1
        for ended, granule in s.ends[1:]:
            end, on_page = granule, []
            for packet in reversed(s.packets[k : k + ended]):  # back from the page's position
                on_page.append((end - len(packet), end, packet))
                end -= len(packet) + (n - 1) * block
            blocks += on_page
            k += ended
    if len({x[1:] for x in setups}) != 1 or sorted(x[0] for x in setups) != list(range(setups[0][1])):
        raise OggError("the streams' headers disagree")
    blocks.sort(key=lambda b: b[0])
    if [b[0] for b in blocks] != [0, *(b[1] for b in blocks)][: len(blocks)]:
        raise OggError("the streams' times leave a gap")
    return Media(b"".join(b[2] for b in blocks), setups[0][3], len(streams), sum(s.pages for s in streams.values()), len(blocks), [b[:2] for b in blocks])


def feature(media: Media) -> str:
    x = np.frombuffer(media.payload, np.uint8).astype(np.int64) - 128
    energy, turns = int((x * x).sum()), int(np.count_nonzero(np.diff(np.signbit(x))))
    return f"streams={media.streams} pages={media.pages} packets={media.packets} last_ms={media.times[-1][1] * 1000 // media.rate} energy={energy} crossings={turns}"


def padded(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + bytes(-len(raw) % 64 or 64 * (not raw))


def encode_column(df: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_bytes, media)."""

    def f(rows):
        made = [padded(t) for t in rows["text"]]
        return {"doc_id": rows["doc_id"], "n_bytes": [n for n, _ in made], "media": [write_ogg(p) for _, p in made]}

    return map_arrow(df.select("doc_id", "text"), f, "doc_id long, n_bytes long, media binary")


def decode_column(df: DataFrame) -> DataFrame:
    """The digests and features of a media column, from its bytes alone."""

    def f(rows):
        read = [read_ogg(m) for m in rows["media"]]
        return {
            "doc_id": rows["doc_id"], "n_bytes": rows["n_bytes"],
            "payload_bytes": [len(m.payload) for m in read], "payload_sha256": [hashlib.sha256(m.payload).hexdigest() for m in read],
            "tail_crc32": [zlib.crc32(m.payload[-64:]) for m in read],
            "media_bytes": [len(m) for m in rows["media"]], "media_sha256": [hashlib.sha256(m).hexdigest() for m in rows["media"]],
            "feature": [feature(m) for m in read],
        }

    return map_arrow(df, f, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op3_media_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return decode_column(written(encode_column(documents(spark, sf_dir)), compression="zstd"))
