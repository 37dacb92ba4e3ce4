"""Media columns: any bytes as an 8-bit greyscale PNG, read back and described by a low-frequency cosine hash.

The writer gives each 64-byte row the filter whose residuals are smallest, packs rows into zlib chunks and guards each
chunk by its CRC; the reader tests every checksum and undoes all five filters with numpy. A document is one row and
one image, so nothing is shuffled and memory is a few copies of GROUP_BYTES of texts, or of the longest text.

Defined cases: a null or empty text is one row of 64 zero bytes; a damaged image raises MediaError; equal payloads give
equal images and features; repeated rows and null ids pass through; an empty table gives an empty result."""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodestone.llm.words import chunks, column_bytes

WIDTH = 64
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Rows are filtered this many at a time.
_BAND = 1 << 14
_DATA = 1 << 20
#: Texts of so many bytes are images at the same time, or one longer text.
GROUP_BYTES = 4 << 20


class MediaError(ValueError):
    """The stored bytes are not a whole, undamaged image of the kind written here."""


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def padded(payload: bytes) -> bytes:
    return payload + bytes(-len(payload) % WIDTH or (WIDTH if not payload else 0))


def _cost(residual: np.ndarray) -> np.ndarray:
    return np.minimum(residual, np.uint8(0) - residual).sum(1, dtype=np.int64)


def encode_png(payload: bytes, level: int = 1) -> bytes:
    """A PNG of rows of WIDTH samples; payload's length must be a positive multiple of WIDTH."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    packer, out = zlib.compressobj(level), []
    for at in range(0, len(rows), _BAND):
        raw = rows[at : at + _BAND]
        left = np.zeros_like(raw)
        left[:, 1:] = raw[:, :-1]
        up = np.zeros_like(raw)
        up[1:] = raw[:-1]
        if at:
            up[0] = rows[at - 1]
        choices = np.stack([raw, raw - left, raw - up])
        best = np.argmin(np.stack([_cost(c) for c in choices]), axis=0)
        lines = np.empty((len(raw), WIDTH + 1), np.uint8)
        lines[:, 0] = best
        lines[:, 1:] = choices[best, np.arange(len(raw))]
        out.append(packer.compress(lines.tobytes()))
    body = b"".join(out) + packer.flush()
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    parts = [_chunk(b"IDAT", body[i : i + _DATA]) for i in range(0, len(body), _DATA)]
    return _SIGNATURE + _chunk(b"IHDR", head) + b"".join(parts) + _chunk(b"IEND", b"")


def _unfilter(lines: np.ndarray, width: int) -> np.ndarray:
    """Undo the row filters. Runs of rows with the same kind of simple filter go at once; the two kinds that need both
    neighbours go sample by sample along a row."""
    kinds, data = lines[:, 0], lines[:, 1:].copy()
    if kinds.max(initial=0) > 4:
        raise MediaError("unknown row filter")
    sub = kinds == 1
    data[sub] = np.cumsum(data[sub], axis=1, dtype=np.uint8)
    cuts = np.flatnonzero(np.diff(kinds)) + 1
    for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(kinds))):
        kind = kinds[lo] if lo < hi else 0
        if kind == 2:
            if lo:
                data[lo] += data[lo - 1]
            data[lo:hi] = np.cumsum(data[lo:hi], axis=0, dtype=np.uint8)
        elif kind > 2:
            for y in range(lo, hi):
                above = data[y - 1].astype(int).tolist() if y else [0] * width
                row, a, c = data[y].tolist(), 0, 0
                for x in range(width):
                    b = above[x]
                    if kind == 3:
                        guess = (a + b) >> 1
                    else:
                        pa_, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                        guess = a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c
                    a, c = (row[x] + guess) & 255, b
                    row[x] = a
                data[y] = row
    return data


def decode_png(image: bytes) -> np.ndarray:
    """The samples, after tests of the signature, every chunk's length and CRC, and the stream's own checksum."""
    if image[:8] != _SIGNATURE:
        raise MediaError("not a PNG")
    at, size, body, ended = 8, None, [], False
    while at < len(image) and not ended:
        if at + 12 > len(image):
            raise MediaError("cut off inside a chunk")
        (n,), kind = struct.unpack_from(">I", image, at), image[at + 4 : at + 8]
        if at + 12 + n > len(image):
            raise MediaError("cut off inside a chunk")
        data = image[at + 8 : at + 8 + n]
        if struct.unpack_from(">I", image, at + 8 + n)[0] != zlib.crc32(kind + data):
            raise MediaError(f"checksum of {kind!r}")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", data)
        elif kind == b"IDAT":
            body.append(data)
        ended = kind == b"IEND"
        at += 12 + n
    if not ended or size is None or size[2:] != (8, 0, 0, 0, 0):
        raise MediaError("no end, or not 8-bit greyscale")
    try:
        raw = zlib.decompress(b"".join(body))
    except zlib.error as e:
        raise MediaError(str(e)) from e
    width, height = size[:2]
    if len(raw) != height * (width + 1):
        raise MediaError("wrong number of samples")
    return _unfilter(np.frombuffer(raw, np.uint8).reshape(height, width + 1), width)


def _cosines(n: int, low: int) -> np.ndarray:
    k, i = np.arange(low)[:, None], np.arange(n)[None, :]
    return np.cos(np.pi * (2 * i + 1) * k / (2 * n)) * np.sqrt(np.where(k == 0, 1, 2) / n)


_SIDE, _LOW = 32, 8
_DCT = _cosines(_SIDE, _LOW)


def _shrink(a: np.ndarray) -> np.ndarray:
    """Area averages of the rows of a in _SIDE equal strips."""
    n = len(a)
    total = np.zeros((n + 1, a.shape[1]))
    np.cumsum(a, axis=0, out=total[1:])
    at = np.arange(_SIDE + 1) * n / _SIDE
    lo = np.minimum(at.astype(int), n)
    part = total[lo] + (at - lo)[:, None] * np.vstack([a, np.zeros((1, a.shape[1]))])[lo]
    return np.diff(part, axis=0) * (_SIDE / n)


def cosine_hash(samples: np.ndarray) -> bytes:
    """64 bits: which of the 8 x 8 lowest cosine coefficients of the 32 x 32 reduction exceed their median."""
    small = _shrink(_shrink(samples.astype(np.float64)).T).T
    low = np.round(_DCT @ small @ _DCT.T, 6).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes()


_FIELDS = [
    ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()),
    ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("media", pa.binary()), ("feature", pa.binary()),
]
_DDL = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, media binary, feature binary"


def describe(text: str | None, level: int = 1) -> tuple:
    raw = (text or "").encode("utf-8", "surrogatepass")
    image = encode_png(padded(raw), level)
    samples = decode_png(image)
    back = samples.tobytes()
    return (len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-WIDTH:]), len(image), hashlib.sha256(image).hexdigest(), image, cosine_hash(samples))


def media_columns(docs: DataFrame, keep_media: bool = True, level: int = 1) -> DataFrame:
    """doc_id, the stored image in `media` (unless keep_media is false), its feature and digests, for each document."""
    names = [n for n, _ in _FIELDS if keep_media or n != "media"]
    ddl = ", ".join(x for x in _DDL.split(", ") if x.split()[0] in names)

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi in chunks(column_bytes(texts)[1], GROUP_BYTES):
                rows = [describe(t.as_py(), level) for t in texts[lo:hi]]
                columns = [pa.array([r[k] for r in rows], kind) for k, (n, kind) in enumerate(_FIELDS) if n in names]
                yield pa.RecordBatch.from_arrays([ids[lo:hi], *columns], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {ddl}")


def op2_media(spark, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    out = media_columns(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_media=False)
    return out.withColumn("feature", F.lower(F.hex("feature")))
