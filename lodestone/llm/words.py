"""Vectorised tokenising of Arrow text columns.

A chunk of documents is one byte buffer; tokens, their hashes and n-gram hashes come from numpy operations over the
whole buffer, so the cost is a few nanoseconds a byte and the memory a small multiple of the chunk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
_U = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words are runs of bytes other than space and tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Terms are runs of ASCII letters and digits and of all bytes beyond ASCII.
NOT_TERM = np.ones(256, bool)
NOT_TERM[48:58] = NOT_TERM[65:91] = NOT_TERM[97:123] = NOT_TERM[128:] = False

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_STEP = _rng.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
_powers = np.ones(1, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        p = np.full(max(n, 64), _BASE)
        p[0] = 1
        _powers = np.cumprod(p)
    return _powers


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about limit bytes; a longer document is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


@dataclass
class Tokens:
    """Tokens of a chunk, in order; bounds[i]:bounds[i + 1] are those of document i; start and stop are bytes."""

    hash: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    bounds: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    @property
    def doc_end(self) -> np.ndarray:
        return np.repeat(self.bounds[1:], np.diff(self.bounds))


def tokenise(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = BLANK) -> Tokens:
    """Tokens between separator bytes, hashed after A-Z become lower case; no token spans two documents."""
    n = len(data)
    if not n:
        e = np.zeros(0, np.int64)
        return Tokens(np.zeros(0, np.uint64), e, e, np.zeros(len(offsets), np.int64))
    gap = separator[data]
    inner = ~gap
    before = np.ones(n, bool)
    before[1:] = gap[:-1]
    after = np.ones(n, bool)
    after[:-1] = gap[1:]
    full = offsets[:-1] < offsets[1:]
    before[offsets[:-1][full]] = True
    after[offsets[1:][full] - 1] = True
    starts = np.flatnonzero(inner & before)
    stops = np.flatnonzero(inner & after) + 1
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return Tokens(np.zeros(0, np.uint64), starts, stops, bounds)
    first = starts[0]
    spans = np.diff(np.append(starts, n))
    longest = int((stops - starts).max())
    place = np.arange(first, n) - np.repeat(starts, spans)
    np.minimum(place, longest, out=place)
    table = np.where(separator, _U(0), _BYTE[LOWER])
    values = table[data[first:]]
    values *= _power(longest + 1)[place]
    h = np.add.reduceat(values, starts - first)
    return Tokens(mix64(h + (stops - starts).astype(np.uint64) * _BASE), starts, stops, bounds)


def ngrams(tokens: Tokens, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the n-token runs that lie in one document."""
    h, total = tokens.hash, len(tokens.hash)
    if total < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(total - n + 1, np.uint64)
    for k in range(n):
        out += h[k : total - n + 1 + k] * _STEP[k]
    at = np.flatnonzero(np.arange(total - n + 1) + n <= tokens.doc_end[: total - n + 1])
    return mix64(out[at]), at


def sequence_hashes(tokens: Tokens, seed: int = 0) -> np.ndarray:
    """For each document, a hash of its whole token sequence."""
    count = np.diff(tokens.bounds)
    out = np.full(len(count), seed, np.uint64)
    if len(tokens.hash):
        place = np.arange(len(tokens.hash)) - np.repeat(tokens.bounds[:-1], count)
        values = mix64(tokens.hash ^ mix64(place.astype(np.uint64) + _U(seed + 1)))
        full = count > 0
        out[full] = np.add.reduceat(values, tokens.bounds[:-1][full])
    return mix64(out + count.astype(np.uint64))
