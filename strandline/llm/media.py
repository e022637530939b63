"""Media columns: signature sniffing, validation, type correction and carving.

An Aho-Corasick automaton finds every magic number in one pass; a validator of each format then checks structure and
lengths at that place, so a magic number that merely occurs in other data is no finding. The declared type is corrected
to what stands at offset 0; valid media at later offsets, outside an earlier finding, are carved.

Defined results: null and empty columns sniff as unknown with nothing carved; a declared type of null is replaced by
what is found or stays null; equal bytes give equal results; a truncated file is not valid.
"""

from __future__ import annotations

import hashlib
import io
import struct
import wave
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandline.llm.common import column_of, slices, tidy

BLOCK = 192
#: Rows, and about as many bytes, that a task has in hand.
ROWS, OCTETS = 1024, 4 << 20
RATE = 8000


@dataclass(frozen=True)
class Found:
    kind: str
    start: int
    length: int


def _riff(data: bytes, at: int) -> int:
    """Length of the WAVE file at `at`, or 0."""
    if len(data) - at < 44 or data[at + 8 : at + 12] != b"WAVE":
        return 0
    total = 8 + struct.unpack_from("<I", data, at + 4)[0]
    if at + total > len(data):
        return 0
    pos, has_format, has_data = at + 12, False, False
    while pos + 8 <= at + total:
        name, size = struct.unpack_from("<4sI", data, pos)
        pos += 8 + size + size % 2
        has_format |= name == b"fmt " and size >= 16
        has_data |= name == b"data"
    return total if has_format and has_data and pos == at + total else 0


def _png(data: bytes, at: int) -> int:
    """Length of the PNG file at `at`, every chunk's checksum right, or 0."""
    pos, first = at + 8, True
    while pos + 12 <= len(data):
        size, name = struct.unpack_from(">I4s", data, pos)
        end = pos + 12 + size
        if end > len(data) or first and (name != b"IHDR" or size != 13):
            return 0
        if zlib.crc32(data[pos + 4 : end - 4]) != struct.unpack_from(">I", data, end - 4)[0]:
            return 0
        pos, first = end, False
        if name == b"IEND":
            return pos - at
    return 0


def _gif(data: bytes, at: int) -> int:
    """Length of the GIF file at `at`, or 0."""
    if at + 13 > len(data):
        return 0
    flags = data[at + 10]
    pos = at + 13 + (3 << (flags & 7) + 1 if flags & 0x80 else 0)
    seen = False
    while pos < len(data):
        mark = data[pos]
        if mark == 0x3B:
            return pos + 1 - at if seen else 0
        if mark == 0x21:
            pos += 2
        elif mark == 0x2C and pos + 10 < len(data):
            local = data[pos + 9]
            pos += 11 + (3 << (local & 7) + 1 if local & 0x80 else 0)
            seen = True
        else:
            return 0
        while pos < len(data) and data[pos]:
            pos += data[pos] + 1
        pos += 1
    return 0


def _bmp(data: bytes, at: int) -> int:
    """Length of the BMP file at `at`, or 0."""
    if at + 54 > len(data):
        return 0
    size, zero, offset, header, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", data, at + 2)
    if zero or planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or header < 40 or not 54 <= offset <= size or at + size > len(data):
        return 0
    return size if width > 0 and height and offset + (width * bits + 31) // 32 * 4 * abs(height) <= size else 0


def _jpeg(data: bytes, at: int) -> int:
    """Length of the JPEG file at `at`, or 0."""
    pos, scan = at + 2, False
    while pos + 4 <= len(data):
        if data[pos] != 0xFF:
            return 0
        mark = data[pos + 1]
        if mark == 0xD9:
            return pos + 2 - at if scan else 0
        pos += 2 + struct.unpack_from(">H", data, pos + 2)[0]
        if mark == 0xDA:
            scan = True
            while (pos := data.find(b"\xff", pos)) >= 0 and pos + 1 < len(data) and (data[pos + 1] == 0 or 0xD0 <= data[pos + 1] <= 0xD7):
                pos += 2
            if pos < 0:
                return 0
    return pos + 2 - at if scan and data[pos : pos + 2] == b"\xff\xd9" else 0


# Magic numbers, the media type and the validator of each format.
SIGNATURES: list[tuple[bytes, str, Callable[[bytes, int], int]]] = [
    (b"RIFF", "audio/wav", _riff),
    (b"\x89PNG\r\n\x1a\n", "image/png", _png),
    (b"GIF87a", "image/gif", _gif),
    (b"GIF89a", "image/gif", _gif),
    (b"BM", "image/bmp", _bmp),
    (b"\xff\xd8\xff", "image/jpeg", _jpeg),
]


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for magic, kind, valid in SIGNATURES:
        out.add_word(magic.decode("latin-1"), (len(magic), kind, valid))
    out.make_automaton()
    return out


def sniff(data: bytes) -> list[Found]:
    """All valid media in data, in order, none inside another."""
    out: list[Found] = []
    free = 0
    for last, (size, kind, valid) in automaton().iter(data.decode("latin-1")):
        at = last + 1 - size
        if at >= free and (length := valid(data, at)):
            out.append(Found(kind, at, length))
            free = at + length
    return out


def corrected_type(declared: str | None, found: list[Found]) -> str | None:
    return found[0].kind if found and found[0].start == 0 else declared


def pad(raw: bytes, block: int = BLOCK) -> bytes:
    """raw with spaces appended up to a positive multiple of block."""
    return raw + b" " * (-len(raw) % block if raw else block)


def wav(payload: bytes, rate: int = RATE) -> bytes:
    """payload as unsigned 8-bit mono samples in a WAVE file."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def samples(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def features(payload: bytes) -> str:
    """Mean, deviation, crossings of the mean a sample, entropy in bits and peak of 8-bit samples."""
    x = np.frombuffer(payload, np.uint8)
    counts = np.bincount(x, minlength=256)
    n = len(x)
    levels = np.arange(256)
    mean = float((counts * levels).sum() / n)
    deviation = float(np.sqrt((counts * (levels - mean) ** 2).sum() / n))
    above = x > mean
    crossings = int(np.count_nonzero(above[1:] != above[:-1]))
    p = counts[counts > 0] / n
    return f"{mean:.4f},{deviation:.4f},{crossings / n:.6f},{-(p * np.log2(p)).sum():.4f},{int(x.max())}"


def store(df: DataFrame, text: str, key: str) -> DataFrame:
    """Key, media (the WAVE file of the padded UTF-8 text), n_bytes, declared_type: the media column of a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in slices(batch.column(1), ROWS, OCTETS):
                part = batch.slice(start, n)
                raw = [(t or "").encode() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([wav(pad(r)) for r in raw], pa.binary()),
                        pa.array([len(r) for r in raw], pa.int64()),
                        pa.array(["application/octet-stream"] * len(raw)),
                    ],
                    names=[key, "media", "n_bytes", "declared_type"],
                )

    kind = df.schema[key].dataType.simpleString()
    return df.select(column_of(key), column_of(text)).mapInArrow(tidy(run), f"`{key}` {kind}, media binary, n_bytes long, declared_type string")


def inspect(media: DataFrame, key: str) -> DataFrame:
    """Sniffs the column `media`: corrected type, embedded files, and for sound the samples read back and their features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in slices(batch.column(1), ROWS, OCTETS):
                part = batch.slice(start, n)
                data = [m or b"" for m in part.column(1).to_pylist()]
                found = [sniff(m) for m in data]
                kinds = [corrected_type(t, f) for t, f in zip(part.column(3).to_pylist(), found, strict=True)]
                payload = [samples(m) if k == "audio/wav" else m for m, k in zip(data, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(kinds, pa.string()),
                        pa.array([len(p) for p in payload], pa.int64()),
                        pa.array([hashlib.sha256(p).hexdigest() for p in payload]),
                        pa.array([zlib.crc32(p[-16:]) for p in payload], pa.int64()),
                        pa.array([len(m) for m in data], pa.int64()),
                        pa.array([hashlib.sha256(m).hexdigest() for m in data]),
                        pa.array([features(p) if p else "" for p in payload]),
                        pa.array([sum(f.start > 0 for f in fs) for fs in found], pa.int64()),
                    ],
                    names=[key, "n_bytes", "media_type", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_carved"],
                )

    kind = media.schema[key].dataType.simpleString()
    return media.select(column_of(key), "media", "n_bytes", "declared_type").mapInArrow(
        tidy(run),
        f"`{key}` {kind}, n_bytes long, media_type string, payload_bytes long, payload_sha256 string, tail_crc32 long,"
        " media_bytes long, media_sha256 string, feature string, n_carved long",
    )
