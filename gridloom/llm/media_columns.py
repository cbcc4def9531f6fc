"""Media columns: ISO base media containers walked without decoding their payload.

``wrap_payloads`` stores bytes losslessly as 8-bit samples: 8 x 8 grey pictures of 64
bytes, in chunks, each chunk's first picture marked as a sync sample. ``media_columns``
walks the nested boxes of any such container, decodes the sample tables (stsd, stts,
stsc, stsz, stco or co64, stss) and gives codec, duration and the byte ranges of the
keyframes; sample bytes are addressed through the tables, never decoded. The first track is
described; samples in movie fragments (moof) aren't, and edit lists don't change the duration.

Defined results: null text counts as empty, whose payload is 64 zero bytes; equal texts
give equal files; bytes that are no container, end early, nest too deep or claim more samples than bytes give nulls; repeated rows
each give a row; other columns are ignored; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import map_texts

#: Bytes of a sample, samples of a chunk, samples a second.
SAMPLE, CHUNK, RATE = 64, 256, 25
#: Boxes that hold boxes, with the bytes before the first of them.
HOLDERS = {b"moov": 0, b"trak": 0, b"mdia": 0, b"minf": 0, b"dinf": 0, b"stbl": 0, b"edts": 0, b"udta": 0, b"moof": 0, b"traf": 0}


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def table(kind: bytes, entries: list[tuple[int, ...]] | list[int], lead: bytes = b"") -> bytes:
    flat = [x for e in entries for x in (e if isinstance(e, tuple) else (e,))]
    return full(kind, lead, struct.pack(f">I{len(flat)}I", len(entries), *flat))


MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def write_container(payload: bytes) -> bytes:
    """ftyp, moov, mdat; the payload is a positive multiple of SAMPLE."""
    samples = len(payload) // SAMPLE
    chunks = -(-samples // CHUNK)
    last = samples - (chunks - 1) * CHUNK
    runs = [(1, min(CHUNK, samples), 1)] + ([(chunks, last, 1)] if chunks > 1 and last < CHUNK else [])
    entry = box(
        b"raw ",
        bytes(6),
        struct.pack(">HHHIIIHHIIIH", 1, 0, 0, 0, 0, 0, 8, 8, 0x480000, 0x480000, 0, 1),
        bytes(32),
        struct.pack(">Hh", 40, -1),
    )
    head = box(b"ftyp", b"qt  ", bytes(4), b"qt  ", b"isom")

    def moov(start: int) -> bytes:
        stbl = box(
            b"stbl",
            full(b"stsd", struct.pack(">I", 1), entry),
            table(b"stts", [(samples, 1)]),
            table(b"stss", [1 + k * CHUNK for k in range(chunks)]),
            table(b"stsc", runs),
            full(b"stsz", struct.pack(">II", SAMPLE, samples)),
            table(b"stco", [start + k * CHUNK * SAMPLE for k in range(chunks)]),
        )
        dinf = box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1)))
        minf = box(b"minf", full(b"vmhd", bytes(8), flags=1), dinf, stbl)
        mdhd = full(b"mdhd", struct.pack(">IIIIHH", 0, 0, RATE, samples, 0x55C4, 0))
        mdia = box(b"mdia", mdhd, full(b"hdlr", bytes(4), b"vide", bytes(12), b"\0"), minf)
        tkhd = full(b"tkhd", struct.pack(">IIIII8xhhHH", 0, 0, 1, 0, samples, 0, 0, 0, 0), MATRIX, struct.pack(">II", 8 << 16, 8 << 16), flags=3)
        mvhd = full(b"mvhd", struct.pack(">IIIIIH10x", 0, 0, RATE, samples, 0x10000, 0x100), MATRIX, bytes(24), struct.pack(">I", 2))
        return box(b"moov", mvhd, box(b"trak", tkhd, mdia))

    start = len(head) + len(moov(0)) + 8
    return head + moov(start) + box(b"mdat", payload)


@dataclass
class Track:
    """The tables of a track."""

    boxes: dict[bytes, bytes] = field(default_factory=dict)
    #: Bytes of the file.
    length: int = 0

    def ints(self, kind: bytes, at: int = 4, width: int = 1, code: str = "I") -> list[tuple[int, ...]]:
        body = self.boxes.get(kind, b"")
        if len(body) < at + 4:
            return []
        (n,) = struct.unpack_from(">I", body, at)
        size = struct.calcsize(f">{code}") * width
        n = min(n, (len(body) - at - 4) // size)
        flat = struct.unpack_from(f">{n * width}{code}", body, at + 4)
        return list(zip(*[iter(flat)] * width))

    def codec(self) -> str:
        return self.boxes[b"stsd"][12:16].decode("latin-1")

    def clock(self) -> tuple[int, int]:
        """Ticks a second, and the ticks of all samples."""
        body = self.boxes[b"mdhd"]
        (rate,) = struct.unpack_from(">I", body, 20 if body[0] else 12)
        return rate, sum(count * ticks for count, ticks in self.ints(b"stts", width=2))

    def samples(self) -> list[tuple[int, int]]:
        """Offset and size of each sample, in order."""
        one, n = self.sizes()
        sizes = [one] * n if one else [x for (x,) in self.ints(b"stsz", 8)]
        offsets = [x for (x,) in self.ints(b"stco") or self.ints(b"co64", code="Q")]
        runs = self.ints(b"stsc", width=3)
        out: list[tuple[int, int]] = []
        for i, (first, per_chunk, _) in enumerate(runs):
            end = runs[i + 1][0] if i + 1 < len(runs) else len(offsets) + 1
            for chunk in range(first, end):
                at = offsets[chunk - 1]
                for size in sizes[len(out) : len(out) + per_chunk]:
                    out.append((at, size))
                    at += size
        return out

    def keyframes(self) -> list[int]:
        """Sample numbers from 0; without a table every sample is one."""
        if b"stss" in self.boxes:
            return [k - 1 for (k,) in self.ints(b"stss")]
        return list(range(self.sizes()[1]))

    def sizes(self) -> tuple[int, int]:
        """The size of all samples, or 0 where a table has them, and their number, which the file's bytes bound."""
        one, n = struct.unpack_from(">II", self.boxes[b"stsz"], 4)
        if one * n > self.length or not one and 4 * n > len(self.boxes[b"stsz"]) - 12:
            raise ValueError("more samples than bytes")
        return one, n


def walk(data: memoryview, start: int, end: int, track: Track | None = None) -> Iterator[Track]:
    """The tracks of the boxes in a stretch, depth first; sizes of 0 and 64 bits are followed."""
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        stop = end if size == 0 else start + size
        if stop > end or stop < body:
            raise ValueError("a box ends behind its parent")
        if kind in HOLDERS:
            inner = Track() if kind == b"trak" else track
            yield from walk(data, body + HOLDERS[kind], stop, inner)
            if kind == b"trak":
                yield inner
        elif track is not None:
            track.boxes[kind] = bytes(data[body:stop])
        start = stop


MADE = {"n_bytes": pa.int64(), "media": pa.binary()}
FIELDS = {
    "codec": pa.string(),
    "duration": pa.float64(),
    "n_samples": pa.int64(),
    "keyframes": pa.list_(pa.struct([("sample", pa.int64()), ("offset", pa.int64()), ("size", pa.int64())])),
    "payload_bytes": pa.int64(),
    "payload_sha256": pa.string(),
    "tail_crc32": pa.int64(),
    "media_bytes": pa.int64(),
    "media_sha256": pa.string(),
}


def describe(media: bytes | None) -> dict:
    """The columns of the first track of a container; the payload is read back through its tables."""
    out: dict = dict.fromkeys(FIELDS)
    if media is None:
        return out
    out |= {"media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest()}
    try:
        track = next(walk(memoryview(media), 0, len(media)))
        track.length = len(media)
        samples, (rate, ticks) = track.samples(), track.clock()
        keyframes = [{"sample": k, "offset": samples[k][0], "size": samples[k][1]} for k in track.keyframes()]
        codec = track.codec()
    except (StopIteration, ValueError, KeyError, IndexError, RecursionError, struct.error):
        return out
    sha, tail, total, i = hashlib.sha256(), b"", 0, 0
    while i < len(samples):  # samples beside each other are one read
        at, size = samples[i]
        while (i := i + 1) < len(samples) and samples[i][0] == at + size:
            size += samples[i][1]
        part = media[at : at + size]
        sha.update(part)
        total += len(part)
        tail = (tail + part[-64:])[-64:]
    return out | {
        "codec": codec,
        "duration": ticks / rate if rate else None,
        "n_samples": len(samples),
        "keyframes": keyframes,
        "payload_bytes": total,
        "payload_sha256": sha.hexdigest(),
        "tail_crc32": zlib.crc32(tail),
    }


def wrap_payloads(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_bytes`` of the text in UTF-8 and its ``media`` file. One map stage."""

    def worker() -> Callable[[list], dict[str, list]]:
        def kernel(texts: list) -> dict[str, list]:
            raw = [(t or "").encode() for t in texts]
            padded = [b + bytes(-len(b) % SAMPLE if b else SAMPLE) for b in raw]
            return {"n_bytes": [len(b) for b in raw], "media": [write_container(p) for p in padded]}

        return kernel

    return map_texts(docs, [id_col], text_col, MADE, worker)


def media_columns(files: DataFrame, keys: list[str], media_col: str = "media") -> DataFrame:
    """The keys, and per file codec, duration in seconds, keyframe byte ranges and digests. One map stage."""

    def worker() -> Callable[[list], dict[str, list]]:
        def kernel(media: list) -> dict[str, list]:
            rows = [describe(m) for m in media]
            return {name: [row[name] for row in rows] for name in FIELDS}

        return kernel

    return map_texts(files, keys, media_col, FIELDS, worker)


def media_digest(described: DataFrame, id_col: str = "doc_id") -> DataFrame:
    ranges = F.array_join(F.transform("keyframes", lambda k: F.concat_ws("+", k["offset"], k["size"])), ",")
    feature = F.concat_ws(
        ";",
        F.concat(F.lit("codec="), F.trim("codec")),
        F.concat(F.lit("duration="), F.format_string("%.2f", "duration")),
        F.concat(F.lit("samples="), F.col("n_samples")),
        F.concat(F.lit("keyframes="), ranges),
    )
    flat = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256"]
    return described.select(id_col, "n_bytes", *flat, feature.alias("feature"))
